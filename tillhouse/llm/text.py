"""What the text operators share: reading tables, the learning split, walking Arrow batches."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: The ASCII white space that separates words: space and \\x09 to \\x0D, which is also what ``bytes.split()`` uses.
SPACE = b" \t\n\x0b\x0c\r"
#: Rows that are handled at once inside a task, so that Python objects of few texts are alive together.
SLICE = 512


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def fold(doc_id: str = "doc_id", folds: int = 5) -> Column:
    """crc32 of the id as text, modulo ``folds``; null for a null id."""
    return F.crc32(F.col(doc_id).cast("string")) % folds


def freed(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The same rows; afterwards Arrow gives back the memory it holds for later, which a worker would keep between tasks."""
    yield from rows
    pa.default_memory_pool().release_unused()


def slices(batches: Iterable[pa.RecordBatch], rows: int = SLICE) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of at most ``rows``."""
    for batch in batches:
        for start in range(0, batch.num_rows, rows):
            yield batch.slice(start, rows)


def map_texts(docs: DataFrame, columns: list[str], schema: str, each: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> DataFrame:
    """``each`` over the named columns only, so that other columns, whatever their names, are not read.

    Text travels as UTF-8 bytes; ``each`` gets batches of at most ``SLICE`` rows.
    """
    picked = [F.col(c).cast("binary") if docs.schema[c].dataType.typeName() == "string" else F.col(c) for c in columns]
    return docs.select(*[c.alias(n) for c, n in zip(picked, columns, strict=True)]).mapInArrow(lambda it: freed(each(slices(it))), schema)


def texts_of(batch: pa.RecordBatch, name: str = "text") -> list[bytes]:
    """The batch's texts as bytes, null as empty."""
    return [x or b"" for x in batch.column(name).to_pylist()]


def keep_rows(docs: DataFrame, text: str, verdict: Callable[[], Callable[[list[bytes]], list[bool]]]) -> DataFrame:
    """The rows of ``docs`` whose text passes, all columns unchanged. ``verdict`` makes the test once per task."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        passes = verdict()
        for batch in slices(batches):
            kept = passes([(x or "").encode() for x in batch.column(text).to_pylist()])
            yield batch.filter(pa.array(kept, pa.bool_()))

    return docs.mapInArrow(lambda it: freed(each(it)), docs.schema)
