"""Merge of saved datasets."""

from __future__ import annotations

import re
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession

from pressloom.sources.readers import read_dataset
from pressloom.sources.writers import write_dataset


def merge(spark: SparkSession, roots: list[str], target: str | None = None, mode: str = "errorifexists") -> DataFrame:
    """Datasets joined split by split; the split is a partition folder, so this is one read of all roots.

    With a `target` the result is saved there, and read back. With the mode `overwrite_splits` the merge can be repeated, after
    a failure or with more roots: the splits are replaced as a whole when all are written, and no row is there twice. The target
    must not be one of the roots then.
    """
    merged = read_dataset(spark, *roots)
    if target is None:
        return merged
    if mode == "overwrite_splits" and any(_below(path, target) for path in merged.inputFiles()):
        raise ValueError(f"{target} is one of the datasets to merge")
    write_dataset(merged, target, mode)
    return read_dataset(spark, target)


def _below(path: str, folder: str) -> bool:
    """Whether a file is in a folder, with or without a scheme in front of either."""
    plain = lambda x: unquote(re.sub(r"^[A-Za-z][A-Za-z0-9+.-]*:(//[^/]*)?", "", x)).rstrip("/")
    return plain(path).startswith(plain(folder) + "/")
