"""What the text operators share: reading, null handling and word splitting."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Bytes of text that a Python worker takes at once, unless a single text is longer. Spark bounds what it sends by bytes, too.
SLICE_BYTES = 4 << 20

#: The characters that separate words: space, and tab to carriage return.
WORD_SPACE = "\x20\t\n\x0b\x0c\r"
WORD_SPACE_REGEX = r"[\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents")


def filled(column: str = "text") -> Column:
    """The text, with null as the empty text."""
    return F.coalesce(F.col(column), F.lit(""))


def words(text: Column) -> Column:
    """array<string> of the maximal runs of characters outside WORD_SPACE; empty for a text without any."""
    trimmed = F.btrim(text, F.lit(WORD_SPACE))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, WORD_SPACE_REGEX))


def let(value: Column, body) -> Column:
    """body(value), with value evaluated once however often body mentions it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def groups_for(rows: int, each: int) -> int:
    """How many groups of about `each` rows hold `rows` rows."""
    return max(1, math.ceil(rows / each))


def slices(batches: Iterator[pa.RecordBatch], column: str, most: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """batches in slices of consecutive rows of at most `most` bytes of `column`, or of one row."""
    for batch in batches:
        ends = pc.cumulative_sum(pc.fill_null(pc.binary_length(batch.column(column)), 0).cast(pa.int64())).to_numpy()
        at = 0
        while at < batch.num_rows:
            stop = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + most, "right")))
            yield batch.slice(at, stop - at)
            at = stop


def free_name(df: DataFrame, name: str) -> str:
    """name, with underscores before it until df has no such column."""
    while name in df.columns:
        name = f"_{name}"
    return name
