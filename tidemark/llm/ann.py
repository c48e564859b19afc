"""Approximate nearest neighbours by inner product: multiprobe p-stable hashing.

* Largest inner product becomes smallest Euclidean distance by one more
  component (Neyshabur and Srebro, ICML 2015): a vector scaled by the largest norm gets
  sqrt(1 - |x|^2), a query is scaled to length 1 and gets 0.
* Each of ``tables`` hashes floors ``hashes`` Gaussian projections over
  ``width`` (Datar et al., SoCG 2004).  Every vector is indexed.
* A query visits its own bucket and the buckets one step away in any of the
  projections in the order of estimated success, the squared distances of its
  projections to the boundaries crossed (Lv et al., VLDB 2007).
* Equal vectors are indexed once with their smallest ids, so a very common vector
  is one entry; buckets are cut in tiles of bounded size.
* A visited tile returns each query's best rows; these are merged over tables
  and rescored by the exact inner product in double precision.
* Queries whose visits found fewer than k vectors are compared with every tile.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import cut
from tidemark.llm.vectors import leaders, matrices, packed, usable

TABLES, HASHES, WIDTH, PROBES = 3, 3, 1.5, 16
SEED = 20240229
TILE_ROWS = 4096
BLOCK_QUERIES = 512


def planes(dim: int, tables: int, hashes: int, width: float, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """Projections and offsets for vectors of one length."""
    rng = np.random.default_rng(seed)
    return rng.standard_normal((tables, hashes, dim + 1)), rng.uniform(0, width, (tables, hashes))


def bucket_key(slots: np.ndarray) -> np.ndarray:
    """One bigint for the slots (last axis) of a bucket."""
    key = np.zeros(slots.shape[:-1], np.uint64)
    for h in range(slots.shape[-1]):
        key = (key ^ slots[..., h].astype(np.int64).view(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
        key ^= key >> np.uint64(29)
    return key.view(np.int64)


def probe_keys(f: np.ndarray, width: float, probes: int) -> np.ndarray:
    """Projections (queries, hashes) -> the bucket keys to visit (queries, probes), best first."""
    steps = np.array(list(itertools.product((0, -1, 1), repeat=f.shape[1])))
    slot = np.floor(f / width).astype(np.int64)
    low = f - slot * width
    cost = ((steps[None] < 0) * low[:, None] ** 2 + (steps[None] > 0) * (width - low[:, None]) ** 2).sum(axis=2)
    order = np.argsort(cost, axis=1, kind="stable")[:, :probes]
    return bucket_key(slot[:, None, :] + steps[order])


def _compare(joined: DataFrame, k: int) -> DataFrame:
    """Rows of (q_ids, q_vs, q_x, ids, vs, x) -> (query, qv, id, v, score): each query's best k rows of the tile."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pairs = zip(matrices(batch, "q_ids", "q_x"), matrices(batch, "ids", "x"))
            for i, ((q_ids, q), (ids, x)) in enumerate(pairs):
                q_vs, vs = (batch.column(c)[i].values.to_numpy() for c in ("q_vs", "vs"))
                best = leaders(q @ x.T, ids, k)
                exact = (x[best] * q[:, None, :]).sum(axis=2)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.repeat(q_ids, best.shape[1])), pa.array(np.repeat(q_vs, best.shape[1])),
                     pa.array(ids[best].ravel()), pa.array(vs[best].ravel()), pa.array(exact.ravel())],
                    ["query", "qv", "id", "v", "score"])
    return joined.select("q_ids", "q_vs", "q_x", "ids", "vs", "x").mapInArrow(
        run, "query long, qv long, id long, v long, score double")


def nearest(vectors: DataFrame, is_query, k: int = 20, id_col: str = "vec_id", vec_col: str = "embedding",
            tables: int = TABLES, hashes: int = HASHES, width: float = WIDTH, probes: int = PROBES,
            seed: int = SEED, tile_rows: int = TILE_ROWS) -> DataFrame:
    """(query_id, rank, vec_id, score): the k nearest rows found for every row whose id
    fulfils ``is_query`` (a function of the id column), its own row excluded.

    Rows whose vector is null, zero or has a null or non-finite component, and rows
    without an id, take no part.  A vector's candidates are those of its length.  Ties go
    to the smaller id; with fewer than k candidates all are returned; a repeated row is
    one candidate; different vectors of one id are rows of their own, as queries and as
    candidates.  Only the two named columns are read.  An empty table gives no row."""
    rows = cut(usable(vectors, id_col, vec_col, allow_zero=False).drop("v"))
    norms = rows.groupBy("n").agg(F.max(F.sqrt(F.aggregate("x", F.lit(0.0), lambda s, c: s + c * c))).alias("norm"))

    # equal vectors: one entry with the k + 1 smallest ids, enough for any query's answer; named by
    # its smallest id and, since an id may have several vectors, the vector's hash
    first = Window.partitionBy("x").orderBy("id")
    entries = cut(rows.withColumn("i", F.row_number().over(first)).filter(F.col("i") <= k + 1)
                  .groupBy("n", "x").agg(F.min("id").alias("id"), F.sort_array(F.collect_list("id")).alias("same"))
                  .withColumn("v", F.xxhash64("x")))
    asked = rows.filter(is_query(F.col("id"))).select(F.col("id").alias("query_id"), "x")
    queries = cut(asked.join(entries.select("x", "n", "v", F.col("id").alias("query")), "x"))
    probing = queries.groupBy("n", "query", "v").agg(F.any_value("x").alias("x")).withColumnRenamed("query", "id")

    def hashed(probe: bool):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            made: dict[int, tuple[np.ndarray, np.ndarray]] = {}
            for batch in batches:
                for at in range(0, batch.num_rows, 512):
                    some = batch.slice(at, 512)
                    lengths = some.column("n").to_numpy()
                    for dim in np.unique(lengths).tolist():
                        part = some.filter(pa.array(lengths == dim))
                        if dim not in made:
                            if len(made) > 64:
                                made.clear()
                            made[dim] = planes(dim, tables, hashes, width, seed)
                        a, b = made[dim]
                        x = part.column("x").flatten().to_numpy().reshape(part.num_rows, -1)
                        if probe:
                            x = x / np.linalg.norm(x, axis=1, keepdims=True)
                            extra = np.zeros(len(x))
                        else:
                            x = x / part.column("norm").to_numpy()[:, None]
                            extra = np.sqrt(np.maximum(0, 1 - (x * x).sum(axis=1)))
                        f = np.einsum("nd,thd->tnh", np.column_stack([x, extra]), a) + b[:, None, :]
                        for t in range(tables):
                            keys = probe_keys(f[t], width, probes) if probe else \
                                bucket_key(np.floor(f[t] / width).astype(np.int64))[:, None]
                            who = np.repeat(np.arange(len(x)), keys.shape[1])
                            named = part.take(pa.array(who))
                            yield pa.RecordBatch.from_arrays(
                                [*(named.column(c) for c in ("n", "id", "v", "x")), pa.array(np.full(len(who), t, np.int32)),
                                 pa.array(keys.ravel())], ["n", "id", "v", "x", "tab", "bucket"])
        return run

    as_hashed = "n int, id long, v long, x array<double>, tab int, bucket long"
    keys = ["n", "tab", "bucket"]

    def tiled(found: DataFrame, size: int) -> DataFrame:
        """Buckets cut in tiles of about ``size`` rows."""
        counts = found.groupBy(*keys).agg(F.ceil(F.count(F.lit(1)) / size).alias("slots"))
        return packed(found.join(counts, keys), keys, F.pmod(F.xxhash64("id", "v"), F.col("slots")))

    index = tiled(entries.select("n", "id", "v", "x").join(norms, "n").mapInArrow(hashed(False), as_hashed), tile_rows)
    visits = tiled(probing.mapInArrow(hashed(True), as_hashed), BLOCK_QUERIES)
    asks = [F.col("ids").alias("q_ids"), F.col("vs").alias("q_vs"), F.col("x").alias("q_x")]
    met = index.select(*keys, "ids", "vs", "x").join(visits.select(*keys, *asks), keys)
    who, what = ["query", "qv"], ["id", "v"]
    found = cut(_compare(met, k + 1).groupBy(*who, *what).agg(F.max("score").alias("score")))

    # queries that found too little meet every tile, in blocks
    totals = entries.groupBy("n").agg(F.count(F.lit(1)).alias("total"))
    counts = found.groupBy(*who).count().withColumnsRenamed({"query": "id", "qv": "v"})
    counted = probing.join(counts, what, "left").join(totals, "n")
    is_short = F.coalesce("count", F.lit(0)) < F.least(F.lit(k + 1), F.col("total"))
    counted = counted.withColumn("tiles", F.ceil(F.col("total") / tile_rows))
    short = counted.filter(is_short).select("n", "id", "v", "x", "tiles")
    sized = entries.select("n", "id", "v", "x").join(totals.withColumn("tiles", F.ceil(F.col("total") / tile_rows)), "n")
    slot = F.pmod(F.xxhash64("id", "v"), F.col("tiles"))
    all_tiles = packed(sized, ["n"], slot)
    blocks = packed(short, ["n", "tiles"], slot).select(
        "n", *asks, F.explode(F.sequence(F.lit(0).cast("long"), F.col("tiles") - 1)).alias("slot"))
    rest = _compare(all_tiles.join(blocks, ["n", "slot"]), k + 1)
    enough = counted.filter(~is_short).select(F.col("id").alias("query"), F.col("v").alias("qv"))
    merged = found.join(enough, who, "left_semi").unionByName(rest)

    per_query = Window.partitionBy(*who).orderBy(F.desc("score"), "id")
    best = merged.withColumn("i", F.row_number().over(per_query)).filter(F.col("i") <= k + 1)
    spread = best.join(entries.select(*what, "same"), what).select(*who, "v", "score", F.explode("same").alias("vec_id"))
    by_id = Window.partitionBy(*who).orderBy(F.desc("score"), "vec_id")
    top = spread.withColumn("i", F.row_number().over(by_id)).filter(F.col("i") <= k + 1).drop("i")
    answer = Window.partitionBy("query_id", "qv").orderBy(F.desc("score"), "vec_id")
    own = (F.col("query_id") == F.col("vec_id")) & (F.col("qv") == F.col("v"))
    return (queries.select("query_id", "query", F.col("v").alias("qv")).join(top, who).filter(~own)
            .withColumn("rank", F.row_number().over(answer)).filter(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))
