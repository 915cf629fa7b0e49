"""What the operators share: inputs, Arrow batches of bounded size, words, packed rows."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparkwarden.session import ship_package

# Bytes of text that one step of an Arrow function looks at, at most, unless a single text is longer.
BATCH_BYTES = 4 << 20
_ARROW_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"
_ARROW_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def prepare(spark: SparkSession) -> None:
    """The package for the Python workers, and batches bounded by bytes as well as rows."""
    ship_package(spark)
    spark.conf.set(_ARROW_BYTES, str(BATCH_BYTES))
    spark.conf.set(_ARROW_ROWS, "4096")


def ascii_lower(text: Column) -> Column:
    return F.translate(text, UPPER, LOWER)


def by_bytes(column: pa.Array, limit: int = BATCH_BYTES) -> Iterator[tuple[int, int]]:
    """Slices [start, end) of a text column with at most ``limit`` bytes each, or one row."""
    start = held = 0
    for i, value in enumerate(column):
        size = len(value.as_buffer()) if value.is_valid else 0
        if i > start and held + size > limit:
            yield start, i
            start, held = i, 0
        held += size
    if start < len(column):
        yield start, len(column)


def map_texts(
    df: DataFrame,
    text: str,
    keep: list[str],
    added: str,
    step: Callable[[list[str | None]], dict[str, Iterable]],
    end: Callable[[], None] = lambda: None,
) -> DataFrame:
    """``keep`` and the columns ``added`` (a DDL text) that ``step`` makes of the texts of a batch.

    ``step`` gets the texts of some rows, balanced by bytes, and returns one value per text and column. ``end`` is called
    when a task ends: its worker may wait long for another one, and what it holds is missing in the other stages.
    """
    prepare(df.sparkSession)
    chosen = df.select(*keep, F.col(text).cast("string").alias("__text"))
    new = T.StructType.fromDDL(added)
    schema = T.StructType([df.schema[c] for c in keep] + new.fields)
    out = [c for c in keep]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        types = to_arrow_schema(new)
        try:
            for batch in batches:
                texts = batch.column(batch.schema.get_field_index("__text"))
                for start, stop in by_bytes(texts):
                    part = batch.slice(start, stop - start)
                    made = step(texts.slice(start, stop - start).to_pylist())
                    arrays = [part.column(part.schema.get_field_index(c)) for c in out]
                    arrays += [pa.array(made[f.name], type=f.type) for f in types]
                    yield pa.RecordBatch.from_arrays(arrays, names=[*out, *types.names])
        finally:
            end()
            pa.default_memory_pool().release_unused()

    return chosen.mapInArrow(run, schema)


def packed(df: DataFrame, *columns: str) -> DataFrame:
    """The named columns, and the whole row as ``__row``: no other column can clash with a helper's name."""
    return df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("__row"), *columns)


def unpacked(df: DataFrame) -> DataFrame:
    return df.select("__row.*")


WORD = re.compile(rb"[^\x20\x09-\x0D]+")
