"""The bitmap misses no hash, the folders of a scope can be given up."""

from __future__ import annotations

import os

import pytest
from pyspark.sql import functions as F

from pressloom.llm import prefilter
from pressloom.llm.prefilter import maybe_in
from pressloom.llm.tables import emptied, scope, stored


def test_no_hash_is_missed(spark, monkeypatch):
    hashes = spark.range(3000).select(F.xxhash64("id").alias("h")).union(spark.createDataFrame([(None,), (0,), (-1,)], "h bigint"))
    test = maybe_in(hashes.repartition(5))
    inside = hashes.where("h IS NOT NULL")
    assert inside.where(test(F.col("h"))).count() == 3002
    other = spark.range(10**6, 10**6 + 20000).select(F.xxhash64("id").alias("h"))
    assert other.where(test(F.col("h"))).count() < 2500
    nothing = maybe_in(hashes.limit(0))
    assert other.where(nothing(F.col("h"))).count() == 0
    # with too few bits it lets all through
    monkeypatch.setattr(prefilter, "MOST_BITS", 1 << 15)
    monkeypatch.setattr(prefilter, "LEAST_BITS", 1 << 15)
    many = spark.range(400_000).select(F.xxhash64("id").alias("h"))
    assert other.where(maybe_in(many)(F.col("h"))).count() == 20000


@pytest.mark.parametrize("direct", [0, 1 << 15])
def test_pieces_of_several_tasks_are_merged(spark, monkeypatch, direct):
    monkeypatch.setattr(prefilter, "DIRECT", direct)
    hashes = spark.range(900).select(F.xxhash64("id").alias("h")).repartition(7)
    test = maybe_in(hashes)
    assert hashes.where(test(F.col("h"))).count() == 900
    assert spark.range(5000, 25000).where(test(F.xxhash64("id"))).count() < 2500


def test_scope(spark):
    with scope(spark, "outer") as folder:
        one, two = stored(spark.range(5), "one"), stored(spark.range(7), "two")
    later = stored(spark.range(3), "later")
    assert all(folder in f for f in [*one.inputFiles(), *two.inputFiles()]) and two.count() == 7
    emptied(spark, folder)
    assert not any(os.path.isdir(os.path.join(folder, f)) for f in os.listdir(folder)) and later.count() == 3
