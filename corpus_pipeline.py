"""The corpus pipeline: language ID, near copies, decontamination, mixing to target weights, token output.

Each stage works on all rows that its predecessor kept. All but the last return the columns of `documents`.
"""

from __future__ import annotations

from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pressloom.llm import mixture
from pressloom.llm.decontam import phrase_matches, positional_index
from pressloom.llm.langid import UNKNOWN, identify, train
from pressloom.llm.mixing import mix
from pressloom.llm.near_dedup import MinMax, without_duplicates
from pressloom.llm.queries import TOKENIZER, table
from pressloom.llm.tables import emptied, new_folder, scope, stored
from pressloom.llm.token_output import read_slots, write_training_order
from pressloom.operators.duplicates import free_name

#: a text whose best language has less of the pooled probability is rejected, as is one without a letter
LEAST_SCORE = 0.35

#: near copies share 0.8 of their shingles or more; 30 bands of 4 miss a pair at 0.8 with (1 - 0.8^4)^30 < 1e-6
NEAR_COPIES = MinMax(percent=80, band=4)


#: folders of the intermediate tables of stages whose results have been written
_spent: list[str] = []


def stage(step):
    """A stage gives up the intermediate tables of the ones before it: its input is a written table. They stay if the input
    still reads one of them."""

    @wraps(step)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        if _spent:
            read = docs.inputFiles()
            for folder in [f for f in _spent if not any(f.rpartition("/")[2] in path for path in read)]:
                emptied(spark, folder)
                _spent.remove(folder)
        with scope(spark, step.__name__) as folder:
            _spent.append(folder)
            return step(spark, docs, sf_dir)

    return run_stage


@stage
def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language that the network knows."""
    labelled = identify(docs, train(docs), keep_text=True)
    return labelled.where((F.col("lang_pred") != UNKNOWN) & (F.col("score") >= LEAST_SCORE)).select(*docs.columns)


@stage
def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group."""
    return without_duplicates(docs, p=NEAR_COPIES)


@stage
def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no window of ten words of a benchmark text occurs."""
    key = free_name(docs, "_key")
    keyed = docs.withColumn(key, F.xxhash64("doc_id", "text"))
    matches = phrase_matches(positional_index(keyed, doc_id=key), table(spark, sf_dir, "benchmark"))
    hit = stored(matches.select(F.col("doc_id").alias(key)).distinct(), "contaminated")
    return keyed.join(hit, key, "left_anti").select(*docs.columns)


@stage
def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in the target weights; one that is taken in two epochs is there twice."""
    out = mix(docs, mixture.WEIGHTS, mixture.domain(), max_epochs=mixture.MAX_EPOCHS, seed=mixture.SEED)
    return out.select(*docs.columns)


@stage
def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every token sequence in training order, as read back from the shards."""
    path = new_folder(spark, "training-order")
    write_training_order(docs, path, TOKENIZER, key=20240607)
    return read_slots(spark, path).withColumn("tokens_sha256", F.sha2("tokens", 256)).drop("tokens")


STAGES = [
    ("language ID", language),
    ("MinHash near-dedup", near_copies),
    ("benchmark decontamination", decontaminate),
    ("mixing to target weights", mixed),
    ("token-ID output", tokens),
]

#: neither a trained network nor a tokenizer can be written in SQL; the stages are tested against brute force
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, step in STAGES[:-1]:
        docs = stored(step(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
