"""Helpers shared by the operators: table reading, lineage cuts, bounded text slices."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.session import ensure_checkpoint_dir

SLICE_BYTES = 1 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def cut(df: DataFrame) -> DataFrame:
    """``df`` written to the shared checkpoint folder and read back (lineage ends there)."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def slices(batch: pa.RecordBatch, column: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """``batch`` in consecutive pieces of about ``limit`` bytes of ``column``; one
    longer text is a piece of its own, whole."""
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_pylist()
    begin, held = 0, 0
    for i, n in enumerate(sizes):
        if held and held + n > limit:
            yield batch.slice(begin, i - begin)
            begin, held = i, 0
        held += n
    if begin < batch.num_rows:
        yield batch.slice(begin)


def doc_bucket(doc_id, n: int):
    """crc32 of the id's decimal text, modulo ``n`` (null ids: null)."""
    return F.crc32(doc_id.cast("string").cast("binary")) % n


def row_hashes(docs: DataFrame) -> DataFrame:
    """``docs`` with ``__h1`` and ``__h2``, 128 bits of hash of the whole row: rows that agree in
    every column, and only they, share them."""
    parts = [F.col(f"`{c}`") for c in docs.columns] + [F.col(f"`{c}`").isNull() for c in docs.columns]
    return docs.withColumns({"__h1": F.xxhash64(*parts), "__h2": F.xxhash64(F.lit("second"), *parts)})
