"""Merkle manifest of a table: a tree of digests per group, a tree over the groups, and an inclusion proof for every row.

Nodes carry nested-interval labels: level and the interval [lo, hi) of the leaf ranks that they cover. A leaf's ancestors are
the nodes whose intervals hold its rank. All nodes of a level have intervals of one width, so that an interval lies in one
bucket of that width, and the containment join is a join on (tree, level, bucket). What an ancestor covers, less what the
child on the leaf's path covers, are two intervals: the siblings on its left and on its right.

Seven levels are a band: the leaves of one block of 3^7 are hashed up to the block's node in one step, and the blocks' nodes are
the leaves of the next band. No key of a shuffle, join or group has more than 3^7 rows, whatever the groups' sizes are. Ranks come
from a range-partitioned sort and the counts of its partitions. Texts are never shuffled. DataFrame operations only.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pressloom.llm.tables import stored, tasks

#: children of a node; levels of a band
FANOUT = 3
LEVELS = 7
WIDTH = FANOUT**LEVELS


def encoded(value: Column) -> Column:
    """`-` for null, else the UTF-8 byte count, a colon and the value as text."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_digest(values: Sequence[Column]) -> Column:
    """Lowercase hex sha256 of the encoded values, one after the other."""
    return F.sha2(F.concat(*[encoded(v) for v in values]), 256)


def _hex(digests: Column) -> Column:
    """The digests of a list as hex text, joined."""
    return F.array_join(F.transform(digests, lambda d: F.lower(F.hex(d))), "")


def _power(level: Column) -> Column:
    """FANOUT ^ level, for the levels of a band."""
    return F.pow(F.lit(float(FANOUT)), level).cast("bigint")


def _height(n: Column) -> Column:
    """Levels above the leaves that a tree of n leaves has in this band."""
    return sum(((n > FANOUT**k).cast("int") for k in range(LEVELS)), F.lit(0))


def _runs(digests: Column) -> Column:
    """Every three consecutive members of a list that is not empty."""
    last = F.floor((F.size(digests) - 1) / FANOUT).cast("int")
    return F.transform(F.sequence(F.lit(0), last), lambda i: F.slice(digests, i * FANOUT + 1, F.lit(FANOUT)))


def ranked(rows: DataFrame, tree: str, order: Sequence[str]) -> DataFrame:
    """Stored rows with `rank`, their place within their tree from 0 on (nulls first), and `n`, the tree's number of rows.

    The rows are sorted by ranges; a tree of any size is spread over as many partitions as it needs. Each partition counts its
    rows of each tree, and the sums over the earlier partitions make the ranks: for a tree, as many rows as it has partitions.
    """
    keys = [F.col(c).asc_nulls_first() for c in (tree, *order)]
    dealt = rows.repartitionByRange(tasks(rows.sparkSession), *keys).sortWithinPartitions(*keys)
    placed = dealt.withColumns({"part": F.spark_partition_id(), "pos": F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))})
    placed = stored(placed, "sorted")
    counts = placed.groupBy("part", tree).agg(F.count("*").alias("c"), F.min("pos").alias("first"))
    own = Window.partitionBy(tree)
    before = own.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("part", tree, "first", F.coalesce(F.sum("c").over(before), F.lit(0)).alias("start"), F.sum("c").over(own).alias("n"))
    out = placed.join(starts, ["part", tree]).withColumn("rank", F.col("pos") - F.col("first") + F.col("start"))
    return stored(out.drop("part", "pos", "first", "start"), "ranked")


def _band(units: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(nodes, units of the next band) of the units (tree, rank, n, digest).

    Nodes are (tree, level, lo, hi, kids): level from 1 in this band, the interval in ranks of units, the children's digests.
    """
    block = F.floor(F.col("rank") / WIDTH).alias("block")
    level = units.groupBy("tree", block).agg(F.sort_array(F.collect_list(F.struct("rank", "digest"))).alias("own"), F.max("n").alias("n"))
    level = level.select("tree", "block", "n", _height(F.col("n")).alias("height"), F.transform("own", lambda u: u["digest"]).alias("d0"))
    none = F.array().cast("array<array<binary>>")
    for k in range(LEVELS):
        # every three consecutive digests; a tree that has come to one node has no further level
        runs = _runs(F.col(f"d{k}"))
        level = level.withColumn(f"k{k}", F.when(F.col("height") > k, runs).otherwise(none))
        above = F.transform(f"k{k}", lambda run: F.unhex(F.sha2(_hex(run), 256)))
        level = level.withColumn(f"d{k + 1}", F.when(F.col("height") > k, above).otherwise(F.col(f"d{k}")))
    level = stored(level.select("tree", "block", "n", *[f"k{k}" for k in range(LEVELS)], F.get(f"d{LEVELS}", F.lit(0)).alias("digest")), "blocks")
    kinds = F.array(*[F.struct(F.lit(k + 1).alias("level"), F.col(f"k{k}").alias("runs")) for k in range(LEVELS)])
    every = level.select("tree", "block", "n", F.explode(kinds).alias("l")).select("tree", "block", "n", "l.level", F.posexplode("l.runs").alias("i", "kids"))
    lo = F.col("block") * WIDTH + F.col("i") * _power(F.col("level"))
    nodes = every.withColumn("lo", lo).select("tree", "level", "lo", F.least(F.col("lo") + _power(F.col("level")), "n").alias("hi"), "kids")
    return nodes, level.select("tree", F.col("block").alias("rank"), F.ceil(F.col("n") / WIDTH).alias("n"), "digest")


def _siblings(units: DataFrame, nodes: DataFrame) -> DataFrame:
    """(tree, rank, own): for each unit below an ancestor of this band, its siblings (level, left, right) by level."""
    each = units.select("tree", "rank", F.explode(F.sequence(F.lit(1), _height(F.col("n")))).alias("level"), "n").where(F.col("level") <= _height(F.col("n")))
    each = each.select("tree", "level", F.floor(F.col("rank") / _power(F.col("level"))).alias("bucket"), "rank")
    above = nodes.withColumn("bucket", F.floor(F.col("lo") / _power(F.col("level"))))
    held = each.join(above, ["tree", "level", "bucket"]).where((F.col("lo") <= F.col("rank")) & (F.col("rank") < F.col("hi")))
    # the path's child covers [from, from + step); [lo, from) and what follows it up to hi are the siblings
    step = _power(F.col("level") - 1)
    start = F.floor(F.col("rank") / step) * step
    place = ((start - F.col("lo")) / step).cast("int")
    entry = F.struct("level", F.slice("kids", F.lit(1), place).alias("left"), F.slice("kids", place + 2, F.lit(FANOUT)).alias("right"))
    return held.select("tree", "rank", entry.alias("e")).groupBy("tree", "rank").agg(F.sort_array(F.collect_list("e")).alias("own"))


def _forest(units: DataFrame) -> tuple[list[tuple[DataFrame, DataFrame]], DataFrame]:
    """([(units, nodes) of each band, lowest first], the trees' roots as units (tree, rank 0, n 1, digest))."""
    bands = []
    while True:
        nodes, above = _band(units)
        bands.append((units, nodes))
        # with one unit left in every tree, there is nothing above
        more = above.where("n > 1").limit(1).count()
        units = above
        if not more:
            return bands, units


def _paths(bands: list[tuple[DataFrame, DataFrame]], above: DataFrame) -> DataFrame:
    """(tree, rank, path, and what `above` has) of the lowest band's units, where `above` (tree, rank, path, ...) is of the roots."""
    for i, (units, nodes) in reversed(list(enumerate(bands))):
        own = units.select("tree", "rank").join(_siblings(units, nodes), ["tree", "rank"], "left").withColumn("block", F.floor(F.col("rank") / WIDTH))
        upper = above.withColumnsRenamed({"rank": "block", "path": "upper"})
        entries = F.transform(F.coalesce("own", F.array().cast("array<struct<level:int,left:array<binary>,right:array<binary>>>")), lambda e: F.struct(e["left"], e["right"]))
        above = own.join(upper, ["tree", "block"]).withColumn("path", F.concat(entries, "upper")).drop("own", "block", "upper")
        above = stored(above, "paths") if i else above
    return above


def fold(leaf: Column, path: Column) -> Column:
    """The root that a leaf (hex) and its siblings lead to."""
    return F.aggregate(path, leaf, lambda h, e: F.sha2(F.concat(_hex(e["left"]), h, _hex(e["right"])), 256))


def proof_digest(path: Column) -> Column:
    """Hex sha256 of all siblings' hex digests, level by level up to the root, left to right."""
    return F.sha2(F.array_join(F.transform(path, lambda e: F.concat(_hex(e["left"]), _hex(e["right"]))), ""), 256)


def manifest(
    rows: DataFrame, values: Sequence[str] = ("doc_id", "source", "lang", "n_chars", "text"), group: str = "source", order: str = "doc_id", now: Sequence[Column] | None = None
) -> DataFrame:
    """(<order>, leaf, now, subroot, root, path) of every row.

    A row's leaf is the digest of its `values`. Within a group, leaves are in ascending `order` (null first, equal ones by their
    digest), and every three consecutive nodes become one until one is left, the group's root; the groups' roots, by group (null
    first, UTF-8 bytewise), become the root in the same way. `path` lists the siblings (left, right: lists of binary digests)
    from the leaf to the root. `now` is null, or the digest of the Columns `now`, the values as they are found at another time.

    Nulls are values of their own. Equal rows are leaves of their own with the same digest. A group of one row has its leaf as
    root; so has a table of one row. An empty table gives an empty result. Other columns play no part.
    """
    key = F.coalesce(F.concat(F.lit("1"), F.col(f"`{group}`").cast("string")), F.lit("0"))
    later = F.unhex(leaf_digest(now)) if now is not None else F.lit(None).cast("binary")
    hashed = rows.select(key.alias("tree"), F.col(f"`{order}`").alias("place"), F.unhex(leaf_digest([F.col(f"`{v}`") for v in values])).alias("digest"), later.alias("now"))
    leaves = ranked(hashed, "tree", ["place", "digest"])
    bands, roots = _forest(leaves.select("tree", "rank", "n", "digest"))
    # the groups are the leaves of one more tree
    groups = ranked(roots.select(F.lit("").alias("tree"), F.col("tree").alias("own_tree"), "digest"), "tree", ["own_tree"])
    top_bands, top = _forest(groups.select("tree", "rank", "n", "digest"))
    empty = F.array().cast("array<struct<left:array<binary>,right:array<binary>>>")
    top_paths = _paths(top_bands, top.select("tree", "rank", empty.alias("path"), F.col("digest").alias("root")))
    above = groups.join(top_paths, ["tree", "rank"]).select(F.col("own_tree").alias("tree"), F.lit(0).cast("bigint").alias("rank"), "path", F.col("digest").alias("subroot"), "root")
    paths = _paths(bands, stored(above, "groups"))
    out = leaves.drop("n").join(paths, ["tree", "rank"])
    text = lambda c: F.lower(F.hex(c)).alias(c)
    return out.select(F.col("place").alias(order), text("digest").alias("leaf"), text("now"), text("subroot"), text("root"), "path")


def verified(found: DataFrame, order: str = "doc_id") -> DataFrame:
    """(<order>, leaf, subroot, root, proof_sha256, folded_root, verified): the root that each row of a `manifest` leads to with
    its values as found (`now`, or the leaf itself where that is null), and whether it is the manifest's."""
    folded = found.withColumns({"proof_sha256": proof_digest(F.col("path")), "folded_root": fold(F.coalesce("now", "leaf"), F.col("path"))})
    return folded.select(f"`{order}`", "leaf", "subroot", "root", "proof_sha256", "folded_root", (F.col("folded_root") == F.col("root")).alias("verified"))


MANIFEST_SQL = r"""
WITH RECURSIVE crc AS (
  SELECT list(list_reduce(range(8), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, i) ORDER BY i) AS t FROM range(256) r(i)),
docs AS (
  SELECT *, doc_id::VARCHAR AS id, list_reduce(list_transform(string_split(doc_id::VARCHAR, ''), lambda x: ascii(x)::BIGINT),
           lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1]), 4294967295) & 1 = 1 AS touched FROM documents, crc),
enc AS (
  SELECT doc_id, source, touched, coalesce(strlen(id) || ':' || id, '-') || coalesce(strlen(source) || ':' || source, '-') || coalesce(strlen(lang) || ':' || lang, '-')
         || coalesce(length(n_chars::VARCHAR) || ':' || n_chars, '-') AS head, text, replace(text, chr(10), '') AS cut FROM docs),
hashed AS (
  SELECT doc_id, source, sha256(head || coalesce(strlen(text) || ':' || text, '-')) AS leaf,
         sha256(head || CASE WHEN touched THEN coalesce(strlen(cut) || ':' || cut, '-') ELSE coalesce(strlen(text) || ':' || text, '-') END) AS now FROM enc),
leaves AS (
  SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS r, count(*) OVER (PARTITION BY source) AS n FROM hashed),
lev(source, l, r, n, d) AS (
  SELECT source, 0, r, n, leaf FROM leaves
  UNION ALL SELECT source, l + 1, r // 3, (n + 2) // 3, sha256(string_agg(d, '' ORDER BY r)) FROM lev WHERE n > 1 GROUP BY source, l, r // 3, n),
sub AS (SELECT source, d, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS r, count(*) OVER () AS n FROM lev WHERE n = 1),
top(l, r, n, d) AS (
  SELECT 0, r, n, d FROM sub
  UNION ALL SELECT l + 1, r // 3, (n + 2) // 3, sha256(string_agg(d, '' ORDER BY r)) FROM top WHERE n > 1 GROUP BY l, r // 3, n),
beside AS (
  SELECT source, l, r, coalesce(string_agg(d, '') OVER before, '') || '|' || coalesce(string_agg(d, '') OVER after, '') AS e FROM lev WHERE n > 1
  WINDOW before AS (PARTITION BY source, l, r // 3 ORDER BY r ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING),
         after AS (PARTITION BY source, l, r // 3 ORDER BY r ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING)),
top_beside AS (
  SELECT l, r, coalesce(string_agg(d, '') OVER before, '') || '|' || coalesce(string_agg(d, '') OVER after, '') AS e FROM top WHERE n > 1
  WINDOW before AS (PARTITION BY l, r // 3 ORDER BY r ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING),
         after AS (PARTITION BY l, r // 3 ORDER BY r ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING)),
low_path AS (
  SELECT f.source, f.r, list(b.e ORDER BY b.l) AS p FROM leaves f JOIN beside b ON f.source IS NOT DISTINCT FROM b.source AND b.r = f.r // (3 ** b.l)::BIGINT GROUP BY f.source, f.r),
top_path AS (SELECT s.source, list(b.e ORDER BY b.l) AS p FROM sub s JOIN top_beside b ON b.r = s.r // (3 ** b.l)::BIGINT GROUP BY s.source),
paths AS (
  SELECT f.doc_id, f.leaf, f.now, s.d AS subroot, (SELECT d FROM top WHERE n = 1) AS root, list_concat(coalesce(lp.p, []), coalesce(tp.p, [])) AS p
  FROM leaves f JOIN sub s ON f.source IS NOT DISTINCT FROM s.source
  LEFT JOIN low_path lp ON lp.source IS NOT DISTINCT FROM f.source AND lp.r = f.r
  LEFT JOIN top_path tp ON tp.source IS NOT DISTINCT FROM f.source)
SELECT *, folded_root = root AS verified FROM (
  SELECT doc_id, leaf, subroot, root, sha256(replace(array_to_string(p, ''), '|', '')) AS proof_sha256,
         list_reduce(p, lambda h, e: sha256(split_part(e, '|', 1) || h || split_part(e, '|', 2)), now) AS folded_root FROM paths)"""
