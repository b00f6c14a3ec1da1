from __future__ import annotations

import random

import pytest
from pyspark.sql.types import LongType, StringType, StructField, StructType

SF_DIR = "/root/testdata/sf0.001"

DOCUMENTS = StructType(
    [
        StructField("doc_id", LongType()),
        StructField("text", StringType()),
        StructField("lang", StringType()),
        StructField("source", StringType()),
        StructField("n_chars", LongType()),
    ]
)


def sentence(rng: random.Random, n: int, words=("lor", "ip", "sum", "dol", "or", "sit", "am", "et", "con", "sec", "té", "tur")) -> str:
    return " ".join("".join(rng.choice(words) for _ in range(rng.randint(1, 3))) for _ in range(n))


def invented(seed: int = 5) -> list[tuple]:
    """Copies, near copies, a chain of near copies, shared passages, short, empty, null and repeated rows, a null id."""
    rng = random.Random(seed)
    rows = []
    add = lambda text, lang="en", source="src1": rows.append((len(rows), text, lang, source, None if text is None else len(text)))
    for _ in range(25):
        add(sentence(rng, rng.randint(3, 120)), rng.choice(["en", "fr", None]), rng.choice(["src0", "src1", "src12", None]))
    base = sentence(rng, 150)
    for _ in range(6):
        add(base)
    chain = base.split()
    for k in range(14):  # each is similar to the one before, the first and the last are not
        chain[10 * k + 2] = f"changed{k}"
        add(" ".join(chain), "fr", "src0")
    passage = sentence(rng, 90)
    for _ in range(8):
        add(sentence(rng, 20) + " " + passage + " " + sentence(rng, 15))
    for text in (None, "", " \t\n", "one", "one two three", "one two three", "ONE Two three", "é ß 12", "%%% !!!", "x" * 5000, "ab" * 3000, sentence(rng, 9000)):
        add(text)
    rows.append((None, sentence(rng, 40), None, None, None))
    rows += [rows[3], rows[3], rows[30]]
    return rows


@pytest.fixture(scope="session")
def documents(spark):
    """The invented rows in several partitions, with columns whose names the operators use themselves."""
    from pyspark.sql import functions as F

    df = spark.createDataFrame(invented(), DOCUMENTS).repartition(3)
    return df.withColumns({"node": F.lit("x"), "key": F.lit(1), "epoch": F.lit(2), "domain": F.lit("d"), "score": F.lit(0.5), "n_tokens": F.lit(-1)})


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], DOCUMENTS)


@pytest.fixture(scope="session")
def tokenizer():
    from pressloom.llm.queries import TOKENIZER

    return TOKENIZER
