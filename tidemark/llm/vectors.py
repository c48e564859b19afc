"""Shared pieces of the vector searches: usable rows, packed tiles, query blocks."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def usable(vectors: DataFrame, id_col: str, vec_col: str, allow_zero: bool) -> DataFrame:
    """(id, v, n, x): rows with an id and a vector of finite components, x as doubles and n its
    length.  Repeated rows count once; different vectors of one id are told apart by v, their hash.
    Vectors of different lengths have no inner product: each length is a search of its own."""
    v = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vec_col).cast("array<double>").alias("x"))
    bad = F.exists("x", lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    v = v.filter(F.col("id").isNotNull() & F.col("x").isNotNull() & (F.size("x") > 0) & ~bad)
    if not allow_zero:
        v = v.filter(F.exists("x", lambda c: c != 0))
    # rows are dealt by id and vector, so not even one id's vectors meet in one task
    rows = v.dropDuplicates(["id", "x"]).withColumn("n", F.size("x"))
    return rows.select("id", F.xxhash64("x").alias("v"), "n", "x")


def packed(rows: DataFrame, keys: list[str], slot) -> DataFrame:
    """One row per (keys, slot): ``ids``, ``vs`` and ``x``, the vectors one after another."""
    made = rows.withColumn("slot", slot).groupBy(*keys, "slot").agg(F.collect_list(F.struct("id", "v", "x")).alias("r"))
    return made.select(*keys, "slot", F.col("r.id").alias("ids"), F.col("r.v").alias("vs"), F.flatten("r.x").alias("x"))


def matrices(batch: pa.RecordBatch, ids: str, x: str, dtype=np.float64):
    """(ids, matrix) of every row of a batch of packed rows."""
    for i in range(batch.num_rows):
        row_ids = batch.column(ids)[i].values.to_numpy()
        yield row_ids, batch.column(x)[i].values.to_numpy().astype(dtype, copy=False).reshape(len(row_ids), -1)


def leaders(scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Row-wise positions of the k highest scores, ties to the smaller id, in order."""
    k = min(k, scores.shape[1])
    kth = np.partition(scores, scores.shape[1] - k, axis=1)[:, -k]
    out = np.empty((len(scores), k), np.int64)
    for r, row in enumerate(scores):
        at = np.nonzero(row >= kth[r])[0]
        out[r] = at[np.lexsort((ids[at], -row[at]))][:k]
    return out
