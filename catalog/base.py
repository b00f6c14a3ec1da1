"""Registry of queries and oracles, table access, SQL fragments."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pressloom.session import ship_package

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

# Whitespace class and entity order of the oracles, written out independently of the library.
WS = r"[\t-\r\x1c-\x20\x85\p{Z}]"


def query(name: str, sql: str | None = None):
    def add(fn):
        @wraps(fn)
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            ship_package(spark)
            return fn(spark, sf_dir)

        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: most rows of a table that `dealt` gives to one task, on average
ROWS_PER_TASK = 4096


def dealt(df: DataFrame, key: str) -> DataFrame:
    """The rows of a table in tasks of a bounded number of rows, at least one for each core. It comes before rows are made wider
    or more, so that nothing else of an extraction or curation is shuffled; the key needs no sort, unlike dealing in turn."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(max(cores, -(-df.count() // ROWS_PER_TASK)), key)


def pick(index: Column, *values: str | None) -> Column:
    """Value at `index % n`, to derive varied rows from a table."""
    return F.get(F.array(*[F.lit(v) for v in values]), F.pmod(index, F.lit(len(values))).cast("int"))


def sql_text(value: str | None) -> str:
    return "NULL" if value is None else "'" + value.replace("'", "''") + "'"


def sql_pick(index: str, *values: str | None) -> str:
    return f"([{', '.join(map(sql_text, values))}])[({index}) % {len(values)} + 1]"


def sql_strip(x: str) -> str:
    return rf"regexp_replace({x}, '^{WS}+|{WS}+$', '', 'g')"


def sql_unify(x: str) -> str:
    lines = rf"regexp_replace({x}, '\n{WS}*\n+', chr(10), 'g')"
    tabs = rf"regexp_replace({lines}, '\t{WS}*\t+', chr(10), 'g')"
    return sql_strip(f"replace({tabs}, chr(160), ' ')")


def sql_squash(x: str) -> str:
    return f"trim(regexp_replace({x}, '{WS}+', ' ', 'g'))"


def sql_entities(x: str) -> str:
    """The entities of the test pages; a cut title may end in one without its semicolon."""
    for name, char in (("&quot;?", '"'), ("&copy;?", "©"), ("&middot;?", "·"), ("&amp;?", "&")):
        x = f"regexp_replace({x}, '{name}', '{char}', 'g')"
    return x


def sql_drop_dot(x: str) -> str:
    """Strip and drop one closing dot; takes a column, not an expression."""
    s = sql_strip(x)
    return f"CASE WHEN length({s}) >= 2 AND {s} LIKE '%.' AND {s} NOT LIKE '%..' THEN left({s}, length({s}) - 1) ELSE {s} END"


def sql_upper_first(x: str) -> str:
    first = f"replace(upper(left({x}, 1)), 'ẞ', 'SS')"
    return f"CASE WHEN length({x}) > 1 AND regexp_matches({x}, '^\\p{{Ll}}') THEN {first} || substr({x}, 2) ELSE {x} END"
