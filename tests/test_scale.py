"""Tasks, shuffles and batches that must not grow with the input; every test makes its own rows."""

from __future__ import annotations

import gc
import os
import re
import shutil

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from catalog import base, jobs
from catalog import pages as page_queries
from pressloom.functions import text
from pressloom.operators import lookups, pages
from pressloom.operators.html import Element
from pressloom.plans.curate import curate
from pressloom.plans.extract import extract
from pressloom.plans.sites import Site, Take
from pressloom.sources import readers, writers


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def tables(spark, tmp_path):
    rows = [(i, f"Titulek {i}.\nText {i}.", "cs", f"src{i % 3}", 9) for i in range(200)]
    spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint").write.parquet(
        str(tmp_path / "documents.parquet")
    )
    return str(tmp_path)


def test_pages_are_dealt_as_documents(spark, tables):
    """One document gives the pages of all sites: documents cross the shuffle, not pages."""
    text = plan(extract(page_queries.site_pages(spark, tables, *page_queries.SITES)))
    assert text.count("Exchange ") == 1 and text.index("Generate explode") < text.index("Exchange ")
    assert text.count("ArrowEvalPython") == 1


def test_required_fields_are_cleaned_once(spark, tables):
    """The filter on them must not repeat their cleaning below the projection that does it."""
    nodes = re.split(r"\n *\+- ", plan(extract(page_queries.site_pages(spark, tables, *page_queries.SITES))))
    for mark in ("ONLINE:", "foto:?"):
        assert [n.split()[0] for n in nodes if mark in n] == ["Project"]


def test_patterns_are_spared_where_no_break_is(spark):
    """The text of an ISO date takes its moment more than once, which is parsed once; texts are cleaned as without the guards."""
    rule = Site(head={"publication_date": Take(("meta",), "attribute", attribute="content")}, root="body", article={})
    parsed = spark.range(1).select(F.lit("x").alias("extractor"), F.struct(F.lit("2020-01-02T03:04:05.250Z").alias("head_publication_date")).alias("raw"))
    assert pages.article_fields(parsed, {"x": rule}).first()["publication_date"] == "2020-01-02 03:04:05.250000+00:00"
    moment = {"_at_head_publication_date": F.lit(0), "_zone_head_publication_date": F.lit("")}
    assert set(pages._moments({"x": rule}, {"head_publication_date"})) == set(moment)
    odd = ["", " a \xa0", "a\n \n\nb", "a\t\tb\n", "\t\n\t\n", "ONLINE:a - denik.cz\nb", "a–b|c ihned.cz x", "a\x0bb", "EXKLUZIVNĚ. a\t \tb", None]
    c = F.col("c")
    plain_title = text.unify(F.regexp_replace(F.replace(c, F.lit("ONLINE:"), F.lit("")), text._SITE_TAIL, ""))
    ways = [
        (text.unify(c, c), text.unify(c)),
        (text.page_headline(c), plain_title),
        (text.page_brief(c), text.unify(F.replace(c, F.lit("EXKLUZIVNĚ."), F.lit("")))),
        (text.unify_all(F.split(c, "a"), c), text.unify_all(F.split(c, "a"))),
    ]
    lines = spark.range(1).select(text.unify_all(F.split(F.lit("a\n \nb,\t\t,c\t\td"), ",")), text.page_keywords(F.lit("a\n \nb,\t\t,c\t\td")))
    assert [list(x) for x in lines.first()] == [["a\nb", "c\nd"]] * 2
    got = spark.createDataFrame([(x,) for x in odd], "c string").select(*[x for way in ways for x in way]).collect()
    assert all(row[2 * i] == row[2 * i + 1] for row in got for i in range(len(ways)))


def test_tasks_grow_with_the_rows(spark, monkeypatch):
    monkeypatch.setattr(base, "ROWS_PER_TASK", 10)
    few, many = (base.dealt(spark.range(n), "id") for n in (5, 205))
    assert few.rdd.getNumPartitions() == spark.sparkContext.defaultParallelism
    assert many.rdd.getNumPartitions() == 21 and many.count() == 205


def test_few_author_lists_shuffle_no_row(spark, tables, monkeypatch):
    """With few lists the texts cross no join shuffle; with more the join is a shuffle, with the same rows."""

    def run():
        return curate(jobs.raw_articles(spark, tables), jobs.author_list(spark, tables))

    def found(df):
        return sorted(df.select("url", "split", "authors", "authors_gender", "headline").collect(), key=str)

    # as with tables of which the planner does not know that they are small
    threshold = "spark.sql.autoBroadcastJoinThreshold"
    spark.conf.set(threshold, "-1")
    try:
        few = run()
        plan_of_few = plan(few)
        monkeypatch.setattr(lookups, "BROADCAST_BYTES", -1)
        many = run()
        plan_of_many = plan(many)
    finally:
        spark.conf.unset(threshold)
    # the names of the lists meet the known ones by a shuffle in either
    assert plan_of_few.count("SortMergeJoin") == plan_of_many.count("SortMergeJoin") - 1
    assert found(few) == found(many) and few.count() == 200 * (2 + 1 + 0 + 1 + 1) / 5


def test_a_batch_of_pages_is_parsed_in_pieces(spark, monkeypatch):
    """Every page of a batch has its own fields, in order, and the batch is bounded for the session."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "10000")
    monkeypatch.setattr(pages, "PAGES_AT_ONCE", 7)
    html = F.concat(F.lit("<html><head><title>T"), F.col("id").cast("string"), F.lit("</title></head><body></body></html>"))
    rows = spark.range(100).coalesce(1).select("id", F.when(F.col("id") != 50, html).alias("html"), F.lit("example").alias("extractor"))
    parsed = pages.parse_pages(rows, {"example": page_queries.EXAMPLE_SITE}, "html")
    got = {r["id"]: r["raw"]["head_headline"] for r in parsed.collect()}
    assert got == {i: None if i == 50 else f"T{i}" for i in range(100)}
    assert int(spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")) == pages.BATCH_PAGES


def test_a_page_leaves_no_elements():
    """The elements of a page hold each other; they must not wait for the collector of cycles."""
    gc.collect()
    gc.disable()
    try:
        raw = pages._raw_fields("<html><head><title>T</title></head><body><p>a<p>b</body></html>", page_queries.EXAMPLE_SITE)
        assert raw["head_headline"] == "T"
        assert not [x for x in gc.get_objects() if isinstance(x, Element)]
    finally:
        gc.enable()


def test_page_files_are_written_by_tasks(spark, tmp_path):
    """A file a page, repeated ids too, in a folder a task; they are read back by far fewer tasks than there are folders."""
    html = [(i % 700, f"<p>{i}é</p>") for i in range(1400)] + [(3, "<p>3é</p>"), (5000, None)]
    pages = spark.createDataFrame(html, "page_id bigint, html string").repartition(40, "page_id")
    for root in (str(tmp_path / "plain"), f"file://{tmp_path / 'uri'}"):
        folders = writers.write_page_files(pages, root, "page_id", "html")
        files = readers.read_html_folder(spark, folders, date="2024-01-01 00:00:00", pattern="*.txt")
        assert files.rdd.getNumPartitions() <= readers.TASKS_PER_CORE * spark.sparkContext.defaultParallelism
        rows = files.select(F.regexp_extract("url", r"page_id=(\d+)", 1).cast("bigint"), F.col("body").cast("string")).collect()
        assert sorted(map(tuple, rows)) == sorted((i, f"{h or ''}\n") for i, h in html)
        again = writers.write_page_files(pages, root, "page_id", "html")
        assert readers.read_html_folder(spark, again, pattern="*.txt").count() == len(html)
    folders = {p.parent for p in tmp_path.glob("plain/**/*.txt")}
    assert len(folders) <= 40


def test_no_page_files(spark, tmp_path):
    spark.createDataFrame([], "page_id bigint, html string").write.parquet(str(tmp_path / "rows"))
    none = base.dealt(spark.read.parquet(str(tmp_path / "rows")), "page_id")
    folders = writers.write_page_files(none, str(tmp_path / "none"), "page_id", "html")
    assert readers.read_html_folder(spark, folders, pattern="*.txt").count() == 0


def test_page_files_of_the_query_need_no_folder_for_each_page(spark, tmp_path, monkeypatch):
    """The job's end on the driver and the listing follow the number of tasks, not that of pages."""
    from catalog import files as file_queries

    rows = [(i, f"https://example.com/{i}", f"<p>{i}</p>") for i in range(60)]
    spark.createDataFrame(rows, "page_id bigint, url string, html string").write.parquet(str(tmp_path / "pages.parquet"))
    seen = []
    read = readers.read_html_folder
    monkeypatch.setattr(readers, "read_html_folder", lambda s, path, **more: seen.append(path) or read(s, path, **more))
    file_queries.read_html_folder(spark, str(tmp_path)).count()
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.txt").load(seen[0])
    assert files.count() == 60
    assert files.select(F.regexp_extract("path", r"^(.*)/", 1)).distinct().count() <= spark.sparkContext.defaultParallelism


def test_page_files_are_listed_and_read_by_tasks(spark, tmp_path, monkeypatch):
    """The driver holds no list of files; the rows are those of Spark's own reader, which still sees to what is not plain."""
    root = tmp_path / "html é %20"
    for folder in ("a", "b", "empty"):
        (root / folder).mkdir(parents=True)
        for i in range(0 if folder == "empty" else 40):
            (root / folder / f"x={i} é.txt").write_bytes(f"{folder}{i}".encode() * i + b"\xff")
    for name, text in ((".x.txt", "h"), ("_y.txt", "h"), ("_y=1.txt", "z"), ("none.txt", ""), ("other.html", "o"), ("w.txt._COPYING_", "c")):
        (root / "a" / name).write_text(text)
    os.utime(root / "a" / "_y=1.txt", ns=(0, 1_600_000_000_123_456_789))
    monkeypatch.setattr(readers, "BATCH_FILES", 7)
    monkeypatch.setattr(readers, "FILES_PER_TASK", 30)

    def rows(path, pattern):
        files = readers.read_html_folder(spark, path, pattern=pattern)
        return plan(files), files.rdd.getNumPartitions(), sorted(map(tuple, files.collect()))

    ways = [(f"file://{root}/*", "*.txt"), (f"{root}/*", "x=?1*"), (f"{root}/a", "*.txt"), (f"{root}/empty", "*.txt")]
    by_tasks = [rows(*way) for way in ways]
    assert [len(r) for _, _, r in by_tasks] == [81, 6, 41, 0] and [n for _, n, _ in by_tasks] == [3, 1, 2, 1]
    assert all("MapInArrow" in text and "FileScan" not in text for text, _, _ in by_tasks)
    odd = [rows(f"{root}/[ab]", "*.txt"), rows(f"{root}/a", "{x,_}*.txt"), rows(f"{root}/a/other.html", "*")]
    (root / "b" / "k=1").mkdir()
    (root / "b" / "k=1" / "x=99.txt").write_text("deep")
    odd.append(rows(f"{root}/b", "*.txt"))
    assert all("FileScan" in text for text, _, _ in odd) and [len(r) for _, _, r in odd] == [81, 41, 1, 1]
    shutil.rmtree(root / "b" / "k=1")
    monkeypatch.setattr(readers, "_files_by_tasks", lambda *_: None)
    assert [rows(*way)[2] for way in ways] == [r for _, _, r in by_tasks]
    with pytest.raises(AnalysisException):
        readers.read_html_folder(spark, f"{root}/missing")
