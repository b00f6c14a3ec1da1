"""Mixing sources to target weights, as DataFrame operations only.

A budget of tokens goes down the tree domain - language - source. At each node it is shared among the children by weight;
a child that can take no more (its supply times the epochs allowed) is filled, and what it leaves goes to its siblings by
weight. Only what no sibling can take is left to the node's own siblings: a node is never given more than its leaves hold.
A leaf's budget is so many whole epochs of its documents, and of one more epoch, in a seeded order, the first documents
until the rest of the budget is reached.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pressloom.llm.tables import ready, stored
from pressloom.operators.duplicates import free_name

LEVELS = ("domain", "lang", "source")
NONE = "(none)"
WIDE = "decimal(38,0)"

Weights = dict[tuple[str, ...], int]


def word_tokens(text: str = "text") -> Column:
    """Words between white space; null has none. The native measure of a document's size."""
    return F.coalesce(F.regexp_count(F.col(f"`{text}`"), F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("bigint")


def _weight(weights: Weights, level: int, default: int) -> Column:
    """Weight of a node: by its whole path, else by its own name under any parents (`*`), else the default."""
    own = {path: w for path, w in weights.items() if len(path) == level + 1}
    if not own:
        return F.lit(default).cast("bigint")
    if any(w < 0 or w != int(w) for w in own.values()):
        raise ValueError("weights are whole numbers, 0 or more")
    table = F.create_map(*[F.lit(x) for path, w in own.items() for x in ("\x1f".join(path), int(w))])
    whole = F.concat_ws("\x1f", *LEVELS[: level + 1])
    anywhere = F.concat_ws("\x1f", *[F.lit("*")] * level, F.col(LEVELS[level]))
    return F.coalesce(F.try_element_at(table, whole), F.try_element_at(table, anywhere), F.lit(default)).cast("bigint")


def _shared(nodes: DataFrame, parents: tuple[str, ...], name: str) -> DataFrame:
    """Budgets of siblings: `budget` of the parent becomes that of the node. Whole tokens; fractions are dropped."""
    ratio = F.col("capacity").cast("double") / F.col("weight").cast("double")
    group = Window.partitionBy(*parents) if parents else Window.partitionBy(F.lit(0))
    before = group.orderBy("ratio", name).rowsBetween(Window.unboundedPreceding, -1)
    ranked = nodes.withColumn("ratio", F.when((F.col("weight") > 0) & (F.col("capacity") > 0), ratio))
    good = F.col("ratio").isNotNull()
    weight = F.when(good, F.col("weight")).otherwise(0).cast(WIDE)
    capacity = F.when(good, F.col("capacity")).otherwise(0).cast(WIDE)
    ranked = ranked.withColumns({"w": weight, "c": capacity})
    zero = F.lit(0).cast(WIDE)
    ranked = ranked.withColumns(
        {
            "left_budget": (F.col("budget") - F.coalesce(F.sum("c").over(before), zero)).cast(WIDE),
            "left_weight": (F.sum("w").over(group) - F.coalesce(F.sum("w").over(before), zero)).cast(WIDE),
        }
    )
    full = ranked.withColumn("full", good & (F.col("c") * F.col("left_weight") <= F.col("left_budget") * F.col("w")))
    rest = full.withColumns(
        {
            "open_budget": (F.col("budget") - F.sum(F.when(F.col("full"), F.col("c")).otherwise(zero)).over(group)).cast(WIDE),
            "open_weight": F.sum(F.when(F.col("full"), zero).otherwise(F.col("w"))).over(group).cast(WIDE),
        }
    )
    share = F.expr("(open_budget * w) div nullif(open_weight, 0)").cast(WIDE)
    budget = F.when(~good, zero).when(F.col("full"), F.col("c")).otherwise(F.coalesce(share, zero)).cast(WIDE)
    return rest.withColumn("budget", budget).drop("ratio", "w", "c", "left_budget", "left_weight", "full", "open_budget", "open_weight")


def budgets(leaves: DataFrame, weights: Weights, budget: int | None, share: tuple[int, int], max_epochs: int, default: int = 1) -> DataFrame:
    """(domain, lang, source, supply, budget) for leaves (domain, lang, source, supply)."""
    tree = leaves.withColumns({f"{x}_weight": _weight(weights, i, default) for i, x in enumerate(LEVELS)})
    usable = F.when((F.col("domain_weight") > 0) & (F.col("lang_weight") > 0) & (F.col("source_weight") > 0), F.col("supply") * max_epochs).otherwise(0)
    tree = tree.withColumn("capacity", usable.cast(WIDE))
    total = tree.agg(F.sum("capacity").alias("capacity"), F.sum("supply").cast(WIDE).alias("supply"))
    wanted = F.lit(budget).cast(WIDE) if budget is not None else F.expr(f"(supply * {int(share[0])}) div {int(share[1])}").cast(WIDE)
    given = total.select(F.least("capacity", wanted).cast(WIDE).alias("budget"))
    for i, name in enumerate(LEVELS):
        path, parents = LEVELS[: i + 1], LEVELS[:i]
        nodes = tree.groupBy(*path).agg(F.sum("capacity").cast(WIDE).alias("capacity"), F.first(f"{name}_weight").alias("weight"))
        # the root's budget is one row; below it, a node takes its parent's
        given = nodes.join(given, list(parents)) if parents else nodes.join(F.broadcast(given), F.lit(True))
        given = _shared(given, parents, name).select(*path, "budget")
    return leaves.join(given, list(LEVELS)).select(*LEVELS, "supply", F.col("budget").cast("bigint").alias("budget"))


def plan(
    rows: DataFrame, weights: Weights, budget: int | None = None, share: tuple[int, int] = (1, 1), max_epochs: int = 4, seed: int = 0, default: int = 1
) -> DataFrame:
    """The stored plan: (domain, lang, source, supply, budget, epochs, cut) for rows (doc_id, domain, lang, source, tokens).

    A leaf's documents are taken `epochs` times, and once more those whose order key is at most `cut` (null: none). The
    place of the cut is found by sums per key prefix, then among the rows of one prefix, so that no leaf's rows meet in one
    task, however large it is.
    """
    leaves = rows.groupBy(*LEVELS).agg(F.sum("tokens").cast("bigint").alias("supply"))
    given = budgets(leaves, weights, budget, share, max_epochs, default)
    whole = F.coalesce(F.expr("budget div nullif(supply, 0)"), F.lit(0).cast("bigint"))
    given = stored(given.withColumn("epochs", whole).withColumn("rest", F.expr("budget - epochs * supply")), "budgets")

    keyed = rows.join(given.where("rest > 0"), list(LEVELS)).select(*LEVELS, "rest", order_key(seed).alias("order"), "tokens")
    by_prefix = keyed.groupBy(*LEVELS, "rest", F.substring("order", 1, 4).alias("prefix")).agg(F.sum("tokens").alias("tokens"))
    up_to = Window.partitionBy(*LEVELS).orderBy("prefix")
    crossed = by_prefix.withColumn("sum", F.sum("tokens").over(up_to)).where("sum >= rest AND sum - tokens < rest")
    crossed = stored(crossed.select(*LEVELS, "prefix", F.expr("rest - (sum - tokens)").alias("rest")), "prefixes")
    near = keyed.drop("rest").withColumn("prefix", F.substring("order", 1, 4)).join(crossed, [*LEVELS, "prefix"])
    by_key = near.groupBy(*LEVELS, "rest", "order").agg(F.sum("tokens").alias("tokens"))
    up_to = Window.partitionBy(*LEVELS).orderBy("order")
    cuts = by_key.withColumn("sum", F.sum("tokens").over(up_to)).where("sum >= rest AND sum - tokens < rest").select(*LEVELS, F.col("order").alias("cut"))
    return stored(given.join(cuts, list(LEVELS), "left").drop("rest"), "plan")


def order_key(seed: int, epochs: str = "epochs", doc_id: str = "doc_id") -> Column:
    """A document's place in the shuffled epoch that its leaf takes part of."""
    return F.md5(F.concat_ws(":", F.lit(str(seed)), F.col(epochs).cast("string"), F.col(doc_id).cast("string")))


def mix(
    documents: DataFrame,
    weights: Weights,
    domain: Column,
    budget: int | None = None,
    share: tuple[int, int] = (1, 1),
    max_epochs: int = 4,
    seed: int = 0,
    default: int = 1,
    tokens: Column | None = None,
    doc_id: str = "doc_id",
    lang: str = "lang",
    source: str = "source",
) -> DataFrame:
    """The rows of `documents`, each as often as it is taken, with `domain`, `n_tokens` and `epoch` (from 0).

    `budget` is in tokens; without it, it is `share` (a fraction) of all tokens. `weights` maps paths, as ("web",),
    ("web", "en"), ("*", "en") or ("*", "*", "src0"), to whole numbers; other nodes have the default. A null domain,
    language or source is a node of its own, `(none)`. A leaf with weight 0 on its path, or without tokens, gets nothing.
    Rows of a leaf that share an id (null ids too) are taken together. The document that reaches the budget is taken whole.
    An empty table gives an empty result. Columns named like the new ones are replaced; others stay.
    """
    ready(documents.sparkSession)
    tokens = word_tokens() if tokens is None else tokens
    # the operator's own columns have names that the input lacks
    name = {x: free_name(documents, f"_{x}") for x in (*LEVELS, "tokens", "id", "epochs", "cut", "copies")}
    own = {name[x]: F.coalesce(F.col(f"`{c}`").cast("string") if isinstance(c, str) else c, F.lit(NONE)) for x, c in zip(LEVELS, (domain, lang, source), strict=True)}
    placed = documents.withColumns({**own, name["tokens"]: F.coalesce(tokens, F.lit(0)).cast("bigint"), name["id"]: F.col(f"`{doc_id}`")})
    narrow = stored(placed.select(F.col(name["id"]).alias("doc_id"), *[F.col(name[x]).alias(x) for x in LEVELS], F.col(name["tokens"]).alias("tokens")), "supply")
    chosen = plan(narrow, weights, budget, share, max_epochs, seed, default)
    chosen = chosen.select(*[F.col(x).alias(name[x]) for x in LEVELS], F.col("epochs").alias(name["epochs"]), F.col("cut").alias(name["cut"]))
    # the plan is read from files, so its size is known: it is broadcast if it is small and joined by a shuffle if not
    joined = placed.join(chosen, [name[x] for x in LEVELS])
    again = F.coalesce(order_key(seed, name["epochs"], name["id"]) <= F.col(name["cut"]), F.lit(False)).cast("bigint")
    taken = joined.withColumn(name["copies"], F.col(name["epochs"]) + again).where(F.col(name["copies"]) > 0)
    kept = [F.col(f"`{c}`") for c in documents.columns if c not in ("domain", "n_tokens", "epoch")]
    epoch = F.explode(F.sequence(F.lit(0).cast("bigint"), F.col(name["copies"]) - 1)).alias("epoch")
    return taken.select(*kept, F.col(name["domain"]).alias("domain"), F.col(name["tokens"]).alias("n_tokens"), epoch)
