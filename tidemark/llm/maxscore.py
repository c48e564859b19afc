"""Exact top-k search by MaxScore over sharded postings.

Every dimension and sign is a term (``+3``: third component above 0); a row's
impact under a term is the size of the component.  A query matches the terms
that raise its score (same sign) and is charged for the others, so the sum of
its matching terms' bounds is an upper bound of any row's score.

Per shard and query (Turtle and Flood, IPM 1995):

1. A term's bound is the query's weight times the shard's largest impact.
2. The threshold is the k-th best score so far; it starts with the rows on top of the
   query's strongest posting list.
3. Terms are split by bounds in ascending order: those whose bounds together stay
   below the threshold are non-essential, since a row found in no other list can not win.
4. Essential postings are traversed; the rows found there are probed in the
   remaining terms, strongest first, while score so far plus the bounds left is
   competitive.  Rows that tie with the threshold stay competitive.

Shards hold a bounded number of rows; their top k are merged.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import cut
from tidemark.llm.vectors import matrices, packed, usable

SHARD_ROWS = 8192
BLOCK_QUERIES = 256
PROBE_TERMS = 8          # terms probed between two prunings
SCALE = 256


class Shard:
    """Postings of one shard: per dimension and sign the rows by falling impact."""

    def __init__(self, ids: np.ndarray, x: np.ndarray, vs: np.ndarray | None = None) -> None:
        by_id = np.argsort(ids, kind="stable")
        self.ids, self.x = ids[by_id], x[by_id]
        self.vs = np.zeros(len(ids), np.int64) if vs is None else vs[by_id]
        self.columns = np.ascontiguousarray(self.x.T)
        self.most = {1: np.maximum(self.x.max(axis=0), 0), -1: np.maximum(-self.x.min(axis=0), 0)}
        self.postings = {}
        for d, column in enumerate(self.columns):
            order = np.argsort(-column, kind="stable")
            self.postings[d, 1] = order[:np.count_nonzero(column > 0)]
            self.postings[d, -1] = order[::-1][:np.count_nonzero(column < 0)]

    def top(self, query_id: int, q: np.ndarray, k: int, v: int = 0) -> tuple[np.ndarray, np.ndarray]:
        """(ids, scores) of the k best rows, the query's own row excluded."""
        sign = np.sign(q)
        bound = np.abs(q) * np.where(sign > 0, self.most[1], self.most[-1])
        terms = np.argsort(bound, kind="stable")              # weakest first
        terms = terms[bound[terms] > 0]
        own = np.nonzero((self.ids == query_id) & (self.vs == v))[0]
        sums = np.cumsum(bound[terms])
        threshold = None
        if len(terms):
            seeds = np.setdiff1d(self.postings[terms[-1], int(sign[terms[-1]])][:4 * k + 1], own)
            if len(seeds) >= k:
                threshold = np.sort(self.x[seeds] @ q)[-k]
        # without a positive threshold even rows in no posting list may win
        weak = int(np.searchsorted(sums, threshold, "left")) if threshold is not None and threshold > 0 else -1
        if weak < 0:
            rows = np.arange(len(self.ids))
        else:
            seen = np.zeros(len(self.ids), bool)
            for d in terms[weak:]:
                seen[self.postings[d, int(sign[d])]] = True
            rows = np.nonzero(seen)[0]
        rows = np.setdiff1d(rows, own, assume_unique=True)
        # strongest terms first, then the dimensions where the query only loses
        order = np.concatenate([terms[::-1], np.setdiff1d(np.nonzero(q)[0], terms)])
        ahead = np.concatenate([np.cumsum(bound[order][::-1])[::-1], [0]])
        score = np.zeros(len(rows), np.int64)
        for at in range(0, len(order), PROBE_TERMS):
            dims = order[at:at + PROBE_TERMS]
            score += q[dims] @ self.columns[dims[:, None], rows]
            if threshold is not None:
                keep = score + ahead[min(at + PROBE_TERMS, len(order))] >= threshold
                rows, score = rows[keep], score[keep]
        best = np.lexsort((self.ids[rows], -score))[:k]
        return self.ids[rows[best]], score[best]


def top_k(vectors: DataFrame, is_query, k: int = 5, id_col: str = "vec_id", vec_col: str = "embedding",
          scale: int = SCALE, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """(query_id, rank, vec_id, score): the k rows of highest integer inner product, exactly,
    for every row whose id fulfils ``is_query``; components are floor(scale * x).

    Rows whose vector is null or has a null or non-finite component, and rows without
    an id, take no part; zero vectors do.  A vector's candidates are those of its length.  Ties
    go to the smaller id; with fewer than k candidates all are returned; a repeated row is
    one candidate; different vectors of one id are rows of their own, as queries and as
    candidates.  Only the two named columns are read.  An empty table gives no row.

    Every shard is sent once, and every query to each shard; only where there are fewer
    shards than cores keep busy is a shard sent a few times, with a part of the queries each."""
    rows = usable(vectors, id_col, vec_col, allow_zero=True)
    rows = cut(rows.select("id", "v", "n", F.transform("x", lambda c: F.floor(scale * c).cast("long")).alias("x")))
    asked = is_query(F.col("id"))
    by_length = rows.groupBy("n").agg(F.ceil(F.count(F.lit(1)) / shard_rows).alias("shards"),
                                      F.greatest(F.lit(1), F.ceil(F.count_if(asked) / BLOCK_QUERIES)).alias("blocks"))
    cores = vectors.sparkSession.sparkContext.defaultParallelism
    shards = by_length.agg(F.sum("shards")).first()[0] or 1
    parts = max(1, -(-4 * cores // shards))
    sized = rows.join(by_length, "n")
    tiles = packed(sized, ["n"], F.pmod(F.xxhash64("id", "v"), F.col("shards"))) \
        .withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(parts - 1)))).withColumn("kind", F.lit(0))
    spread = max(1, -(-parts // 4))     # small blocks, so that every part has some
    blocks = packed(sized.filter(asked), ["n", "shards"], F.pmod(F.xxhash64("v", "id"), F.col("blocks") * parts * spread)) \
        .withColumn("part", F.pmod("slot", F.lit(parts)).cast("int")) \
        .withColumn("slot", F.explode(F.sequence(F.lit(0).cast("long"), F.col("shards") - 1))).withColumn("kind", F.lit(1))
    place = ["n", "slot", "part"]
    columns = [*place, "kind", "ids", "vs", "x"]
    met = (tiles.select(columns).unionByName(blocks.select(columns))
           .repartition(min(shards * parts, 8 * cores), *place).sortWithinPartitions(*place, "kind"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard = None
        for batch in batches:
            for i, (ids, x) in enumerate(matrices(batch, "ids", "x", np.int64)):
                vs = batch.column("vs")[i].values.to_numpy()
                if batch.column("kind")[i].as_py() == 0:
                    shard = Shard(ids, x, vs)
                    continue
                found = [shard.top(i, q, k, v) for i, q, v in zip(ids.tolist(), x, vs.tolist())]
                times = [len(f[0]) for f in found]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.repeat(ids, times)), pa.array(np.repeat(vs, times)),
                     pa.array(np.concatenate([f[0] for f in found])),
                     pa.array(np.concatenate([f[1] for f in found]))], ["query_id", "v", "vec_id", "score"])
    found = met.mapInArrow(run, "query_id long, v long, vec_id long, score long")
    order = Window.partitionBy("query_id", "v").orderBy(F.desc("score"), "vec_id")
    return (found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))
