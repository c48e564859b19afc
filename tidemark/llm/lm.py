"""Cross-entropy difference scoring with two character n-gram models.

A target and a background model (Moore and Lewis, ACL 2010) are matched: the same
order, smoothing and vocabulary, and counts scaled to the same number of tokens.  Tokens
are the UTF-16 units of the lower-cased text (a character above U+FFFF is two); n-grams of
order 4 are counted exactly over every text of both corpora, and each order below is summed
from the one above it.  The counts stay distributed tables
that grow with the corpora: nothing is hashed, folded or broadcast.  To score, documents are
dealt in blocks of bounded text; the distinct n-grams of a block are joined to their losses,
which come back to the block.  A document's score is its mean
loss per token under the target model minus that under the background model:
the lower, the more it resembles the target.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.chars import code_points, segments
from tidemark.llm.common import cut, slices

ORDER = 4
LEAD = ORDER - 1               # characters before a token that count
MU = 4.0                       # weight of the next lower order
UNIT_BITS = 16                 # of a token: four fill a bigint
HELD_GRAMS = 1 << 21           # counted n-grams that a task holds before it merges them
BLOCK_CHARS = 1 << 22          # text of a block of documents; its distinct n-grams are fewer
ROW_CHARS = 64                 # what a row counts besides its text, so that blocks of short texts end too


def grams(parts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(packed n-grams of segments with LEAD characters in front, one for each unit of the segments'
    own characters; their number in each segment).  The last token has the lowest bits."""
    cps, chars = code_points(parts)
    own = np.ones(len(cps), bool)
    starts = np.cumsum(chars) - chars
    own[(starts[:, None] + np.arange(LEAD)).ravel()] = False
    units, counts = cps.astype(np.uint64), chars - LEAD
    pairs = cps > 0xFFFF
    if pairs.any():
        first = np.arange(len(cps)) + np.cumsum(pairs) - pairs      # place of each character's first unit
        above = cps[pairs].astype(np.uint64) - np.uint64(0x10000)
        counts = counts + np.add.reduceat((pairs & own).astype(np.int64), starts)
        units[pairs] = np.uint64(0xD800) + (above >> np.uint64(10))
        units, own = np.repeat(units, 1 + pairs), np.repeat(own, 1 + pairs)
        units[first[pairs] + 1] = np.uint64(0xDC00) + (above & np.uint64(0x3FF))
    key = units.copy()
    for n in range(1, ORDER):
        key[n:] |= units[:-n] << np.uint64(UNIT_BITS * n)
    return key[own].view(np.int64), counts


@dataclass
class Models:
    """counts: for each order (gram, tn, bn), how often target and background have each n-gram;
    their tokens, and the size of the shared vocabulary."""
    counts: dict[int, DataFrame]
    target: int
    background: int
    kinds: int


def _counts(corpus: DataFrame, text_col: str) -> DataFrame:
    """(gram, n): how often each n-gram is in all texts; an n-gram may have several rows."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray]] = []

        def merged() -> tuple[np.ndarray, np.ndarray]:
            keys, where = np.unique(np.concatenate([k for k, _ in held]), return_inverse=True)
            return keys, np.bincount(where, np.concatenate([n for _, n in held]), minlength=len(keys)).astype(np.int64)

        def told() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(held[0][0]), pa.array(held[0][1])], ["gram", "n"])
        for batch in batches:
            for piece in slices(batch, "t"):
                for _, parts in segments(piece.column("t").to_pylist(), LEAD, 0):
                    held.append(np.unique(grams(parts)[0], return_counts=True))
                    if sum(len(k) for k, _ in held) > HELD_GRAMS:
                        held = [merged()]
                        if len(held[0][0]) > HELD_GRAMS // 2:
                            yield told()
                            held = []
        if held:
            held = [merged()]
            yield told()
    return corpus.select(F.col(text_col).alias("t")).mapInArrow(count, "gram long, n long")


def fit(target: DataFrame, background: DataFrame, text_col: str = "text") -> Models:
    """The two matched models over one vocabulary.  Only totals reach the driver; a corpus
    without text gives the uniform model."""
    none = F.lit(0).cast("long")
    both = _counts(target, text_col).select("gram", F.col("n").alias("tn"), none.alias("bn")).unionAll(
        _counts(background, text_col).select("gram", none.alias("tn"), F.col("n").alias("bn")))
    sums = [F.sum("tn").alias("tn"), F.sum("bn").alias("bn")]
    counts = {ORDER: cut(both.groupBy("gram").agg(*sums))}
    for n in range(ORDER - 1, 0, -1):
        counts[n] = cut(counts[n + 1].groupBy(_low("gram", n).alias("gram")).agg(*sums))
    got = counts[1].agg(F.sum("tn"), F.sum("bn"), F.count("*")).first()
    return Models(counts, got[0] or 0, got[1] or 0, got[2] + 1)        # and one unseen token


def _low(gram: str, n: int):
    """The last n tokens of a packed n-gram."""
    return F.col(gram) if n == ORDER else F.col(gram).bitwiseAND(F.lit((1 << UNIT_BITS * n) - 1))


def _losses(asked: DataFrame, models: Models) -> DataFrame:
    """(gram, lt, lb): -log2 of the probability of the last token of each asked n-gram in both models;
    each order backs off to the next lower one.  ``asked`` has one row for each n-gram.

    A context or lower order is shared by at most 2**16 n-grams of the order above."""
    matched = min(models.target, models.background) or max(models.target, models.background)
    sides = {"t": models.target, "b": models.background}
    scale = {x: matched / n if n else 0.0 for x, n in sides.items()}
    some = {x: F.coalesce(F.col(f"{x}n"), F.lit(0)) * scale[x] for x in sides}
    found = None
    for n in range(1, ORDER + 1):
        keys = asked if n == ORDER else asked.select(_low("gram", n).alias("gram")).distinct()
        keys = keys.join(models.counts[n], "gram", "left")
        if found is None:
            p = {x: (some[x] + 1) / F.lit(float((matched if sides[x] else 0) + models.kinds)) for x in sides}
        else:
            context = F.shiftrightunsigned("gram", UNIT_BITS)
            before = models.counts[n].groupBy(context.alias("context")) \
                .agg(*[(F.sum(f"{x}n") * scale[x]).alias(f"{x}c") for x in sides])
            keys = keys.withColumn("context", context).withColumn("low", _low("gram", n - 1)) \
                .join(before, "context", "left").join(found.withColumnRenamed("gram", "low"), "low")
            p = {x: (some[x] + MU * F.col(f"{x}p")) / (F.coalesce(F.col(f"{x}c"), F.lit(0.0)) + MU) for x in sides}
        found = keys.select("gram", *[p[x].alias(f"{x}p") for x in sides])
    return found.select("gram", *[(-F.log2(f"{x}p")).alias(f"l{x}") for x in sides])


def score(docs: DataFrame, models: Models, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: (doc_id, n_tokens, loss_target, loss_background, score),
    losses in bits per token over the whole text.

    Null and empty texts have 0 tokens and 0.0 everywhere; a repeated row gets a
    repeated result; an empty table gives no row.  Other columns are not read."""
    two = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("t"))
    blocks = max(1, -(-(two.agg(F.sum(F.coalesce(F.length("t"), F.lit(0)).cast("long") + ROW_CHARS)).first()[0] or 0) // BLOCK_CHARS))
    # the input partition spreads copies of a row; a rerun of its task deals the same
    dealt = two.withColumn("block", F.pmod(F.xxhash64("doc_id", "t", F.spark_partition_id()), F.lit(blocks))) \
        .repartition("block")

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list[np.ndarray]] = {}
        for batch in batches:
            for piece in slices(batch, "t"):
                of = piece.column("block").to_numpy()
                texts = np.array(piece.column("t").to_pylist(), object)
                for block in np.unique(of).tolist():
                    for _, parts in segments(texts[of == block].tolist(), LEAD, 0):
                        seen = held.setdefault(block, [])
                        seen.append(np.unique(grams(parts)[0]))
                        if sum(map(len, seen)) > HELD_GRAMS:
                            held[block] = [np.unique(np.concatenate(seen))]
        for block, seen in held.items():
            keys = np.unique(np.concatenate(seen))
            for at in range(0, len(keys), 1 << 16):
                k = keys[at:at + (1 << 16)]
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(k), block)), pa.array(k)], ["block", "gram"])

    def answer(rows: pa.Table, known: pa.Table) -> pa.Table:
        by = np.argsort(known.column("gram").to_numpy())
        keys = known.column("gram").to_numpy()[by]
        losses = [known.column(c).to_numpy()[by] for c in ("lt", "lb")]
        counts, sums = np.zeros(rows.num_rows, np.int64), np.zeros((2, rows.num_rows))
        first = 0
        for batch in rows.select(["t"]).combine_chunks().to_batches():
            for piece in slices(batch, "t"):
                for number, parts in segments(piece.column("t").to_pylist(), LEAD, 0):
                    key, n = grams(parts)
                    at, of = np.searchsorted(keys, key), np.repeat(number + first, n)
                    counts += np.bincount(of, minlength=len(counts))
                    for k, loss in enumerate(losses):
                        sums[k] += np.bincount(of, loss[at], minlength=len(counts))
                first += piece.num_rows
        means = sums / np.maximum(1, counts)
        return pa.table([rows.column("doc_id"), pa.array(counts), pa.array(means[0]), pa.array(means[1]),
                         pa.array(means[0] - means[1])],
                        ["doc_id", "n_tokens", "loss_target", "loss_background", "score"])
    # an n-gram has at most one row for each block, so none is a large part of them; written, since
    # every order's losses and the answers read them
    asked = cut(dealt.mapInArrow(ask, "block long, gram long"))
    each = asked.select("gram").distinct()
    answers = asked.join(_losses(each, models), "gram").select("block", "gram", "lt", "lb")
    return dealt.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(
        answer, "doc_id long, n_tokens long, loss_target double, loss_background double, score double")
