"""Language identification by language-bitmask n-gram filters.

Every n-gram of a text (three lower-cased characters around a letter; what is no
letter counts as a space) is looked up in one bit-sliced Bloom filter: a slot
holds a bit per language, and the bitwise AND of an n-gram's slots gives
all languages that contain it.  A language's count of hits is corrected for its
filter's false positives, and the largest corrected count decides.

The number of slots follows from the largest number of n-grams of a language, so that no
language has more than ``MOST_FALSE`` false positives.  A filter of up to ``BROADCAST_BYTES`` is
broadcast; a larger one stays a distributed table to which n-grams are joined.

A language contains an n-gram if the n-gram's share of that language's text is at
least ``least_share`` of its largest share in any language; shares are counted over
every training text.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.chars import MIX, code_points, mixed, segments
from tidemark.llm.common import cut, slices

SLOTS = 1 << 20                # at least
HASHES = 3
MOST_FALSE = 0.01              # expected false positives of the fullest language
BROADCAST_BYTES = 1 << 25      # largest filter that is broadcast: 4 million slots for 64 languages
BLOCK_CHARS = 1 << 22          # text of a block of documents whose n-grams are joined to the filter
ROW_CHARS = 64                 # what a row counts besides its text
LEAST_SHARE = 0.2
UNKNOWN = "und"
MOST_LANGUAGES = 4096          # 64 masks of 64 bits a slot; more is an error, not a cut
HELD_GRAMS = 1 << 21           # counted n-grams that a task holds before it merges them


def letter_table() -> np.ndarray:
    """True for code points that are letters."""
    return np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)


def grams(parts: list[str], letters: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(n-grams as integers, number of n-grams of each segment): one per letter of segments
    with one more character on each side."""
    cps, counts = code_points(parts)
    spaced = np.where(letters[cps], cps, 0).astype(np.uint64)
    ends = np.cumsum(counts)
    is_gram = spaced > 0
    is_gram[ends - counts] = False
    is_gram[ends - 1] = False
    at = np.nonzero(is_gram)[0]
    key = (spaced[at - 1] << np.uint64(42)) | (spaced[at] << np.uint64(21)) | spaced[at + 1]
    return key.view(np.int64), np.bincount(np.searchsorted(ends, at, "right"), minlength=len(counts))


def slots_of(key: np.ndarray, slots: int, hashes: int) -> list[np.ndarray]:
    """The slots of each n-gram; ``slots`` is a power of two."""
    one = mixed(key.view(np.uint64) + MIX)
    step = mixed(one) | np.uint64(1)
    return [((one + np.uint64(i) * step) & np.uint64(slots - 1)).astype(np.int64) for i in range(hashes)]


def slots_for(most: int, least: int, hashes: int) -> int:
    """The power of two, ``least`` or more, at which ``most`` n-grams of a language have at most
    ``MOST_FALSE`` expected false positives."""
    needed = -hashes * most / math.log1p(-MOST_FALSE ** (1 / hashes))
    return max(least, 1 << math.ceil(math.log2(max(1, needed))))


@dataclass
class Slots:
    """A filter that is not broadcast: ``table`` has (plane, slot, mask) of every slot that is set."""
    known: list[str]
    table: DataFrame
    false: np.ndarray
    slots: int
    hashes: int


def _bits(masks: DataFrame) -> dict[int, int]:
    """How many of the masks each language's number is in (numbers of set bits only)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            plane, mask = batch.column("plane").to_numpy(), batch.column("mask").to_numpy().view(np.uint64)
            for p in np.unique(plane).tolist():
                n = [np.count_nonzero(mask[plane == p] & np.uint64(1 << i)) for i in range(64)]
                yield pa.RecordBatch.from_arrays([pa.array(np.arange(64) + 64 * p), pa.array(n, pa.int64())], ["number", "n"])
    counted = masks.select("plane", "mask").mapInArrow(run, "number long, n long").groupBy("number").agg(F.sum("n").alias("n"))
    return {r.number: r.n for r in counted.collect()}


def _counted(train: DataFrame) -> DataFrame:
    """(lang, gram, n) over all training texts."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        letters = letter_table()
        held: dict[str, list[tuple[np.ndarray, np.ndarray]]] = {}

        def merged(parts):
            keys, where = np.unique(np.concatenate([k for k, _ in parts]), return_inverse=True)
            return keys, np.bincount(where, np.concatenate([n for _, n in parts]), minlength=len(keys)).astype(np.int64)
        for batch in batches:
            for piece in slices(batch, "t"):
                texts, langs = np.array(piece.column("t").to_pylist(), object), np.array(piece.column("lang").to_pylist(), object)
                for lang in dict.fromkeys(langs.tolist()):
                    for _, some in segments(texts[langs == lang].tolist(), 1, 1):
                        parts = held.setdefault(lang, [])
                        parts.append(np.unique(grams(some, letters)[0], return_counts=True))
                        if sum(len(k) for k, _ in parts) > HELD_GRAMS:
                            held[lang] = [merged(parts)]
        for lang, parts in held.items():
            keys, n = merged(parts)
            for at in range(0, len(keys), 1 << 16):
                k = keys[at:at + (1 << 16)]
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(k), pa.string()), pa.array(k),
                                                  pa.array(n[at:at + (1 << 16)])], ["lang", "gram", "n"])
    return train.mapInArrow(run, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))


def fit(train: DataFrame, text_col: str = "text", lang_col: str = "lang", slots: int = SLOTS,
        hashes: int = HASHES, least_share: float = LEAST_SHARE) -> Broadcast | Slots:
    """The filter learned from every row with a language: ``slots`` masks for each 64 languages, or
    as many more as the counted n-grams need (``slots_for``)."""
    rows = train.select(F.col(text_col).alias("t"), F.col(lang_col).cast("string").alias("lang")).filter("lang IS NOT NULL")
    counts = cut(_counted(rows))
    totals = counts.groupBy("lang").agg(F.sum("n").alias("total"))
    known = [r.lang for r in totals.orderBy("lang").limit(MOST_LANGUAGES + 1).collect()]
    if len(known) > MOST_LANGUAGES:
        raise ValueError(f"more than {MOST_LANGUAGES} languages: a filter has a bit for each")
    spark = train.sparkSession
    number = spark.createDataFrame([(lang, i) for i, lang in enumerate(known)], "lang string, number int")
    # at most MOST_LANGUAGES rows
    share = counts.join(F.broadcast(totals.join(number, "lang")), "lang").withColumn("share", F.col("n") / F.col("total"))
    by_gram = Window.partitionBy("gram")
    inside = share.withColumn("most", F.max("share").over(by_gram)).filter(F.col("share") >= least_share * F.col("most"))
    masks = cut(inside.groupBy("gram", (F.col("number") / 64).cast("int").alias("plane"))
                .agg(F.bit_or(F.expr("shiftleft(1L, number % 64)")).alias("mask")))
    slots = slots_for(max(_bits(masks).values(), default=0), slots, hashes)
    planes = max(1, -(-len(known) // 64))

    def placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in slots_of(batch.column("gram").to_numpy(), slots, hashes):
                yield pa.RecordBatch.from_arrays([batch.column("plane"), pa.array(at), batch.column("mask")],
                                                 ["plane", "slot", "mask"])
    full = masks.mapInArrow(placed, "plane int, slot long, mask long").groupBy("plane", "slot").agg(F.bit_or("mask").alias("mask"))
    if 8 * planes * slots > BROADCAST_BYTES:
        full = cut(full)
        n = _bits(full)
        return Slots(known, full, np.array([n.get(i, 0) / slots for i in range(len(known))]) ** hashes, slots, hashes)
    got = full.toArrow()
    table = np.zeros((planes, slots), np.uint64)
    table[got.column("plane").to_numpy(), got.column("slot").to_numpy()] = got.column("mask").to_numpy().view(np.uint64)
    # share of a language's bits that are set, to the power of the hashes: its false positives
    false = np.array([np.count_nonzero(table[i // 64] & np.uint64(1 << (i % 64))) / slots for i in range(len(known))]) ** hashes
    return spark.sparkContext.broadcast((known, table, false, hashes))


def _tally(hits: np.ndarray, of: np.ndarray, masks: list[np.ndarray]) -> None:
    """Adds to ``hits`` (texts by languages) the languages in the masks of the texts' n-grams."""
    for i in range(hits.shape[1]):
        there = (masks[i // 64] >> np.uint64(i % 64)) & np.uint64(1)
        hits[:, i] += np.bincount(of, there, minlength=len(hits))


def _decided(known: list[str], false: np.ndarray, hits: np.ndarray, counts: np.ndarray) -> tuple[pa.Array, pa.Array]:
    """(lang_pred, score) of texts from their hits and numbers of n-grams."""
    if known:
        hits = np.maximum(0, (hits - counts[:, None] * false) / np.maximum(1e-9, 1 - false))
    best = hits.argmax(axis=1)
    total = hits.sum(axis=1)
    score = np.where(total > 0, hits[np.arange(len(best)), best] / np.maximum(total, 1e-300), 0.0)
    named = [known[b] if n and known else UNKNOWN for b, n in zip(best.tolist(), counts.tolist())]
    return pa.array(named, pa.string()), pa.array(score)


def predict(docs: DataFrame, model: Broadcast | Slots, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: (doc_id, lang_pred, score), from the whole text.

    ``score`` is the predicted language's part of all corrected counts (0 to 1).  Texts that are
    null or have no letter: ``und`` and 0.  No hit in any language: the first
    learned language and 0.  Ties go to the language first in order.  A repeated row
    gets a repeated result; an empty table gives no row.  Other columns are not read."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, table, false, hashes = model.value
        letters = letter_table()
        for batch in batches:
            for piece in slices(batch, "t"):
                counts = np.zeros(piece.num_rows, np.int64)
                hits = np.zeros((piece.num_rows, max(1, len(known))))
                for number, parts in segments(piece.column("t").to_pylist(), 1, 1):
                    key, n = grams(parts, letters)
                    at = slots_of(key, table.shape[1], hashes)
                    of = np.repeat(number, n)
                    counts += np.bincount(of, minlength=len(counts))
                    _tally(hits, of, [np.bitwise_and.reduce([plane[s] for s in at]) for plane in table])
                yield pa.RecordBatch.from_arrays([piece.column("doc_id"), *_decided(known, false, hits, counts)],
                                                 ["doc_id", "lang_pred", "score"])
    two = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("t"))
    if isinstance(model, Slots):
        return _predict_joined(two, model)
    return two.mapInArrow(run, "doc_id long, lang_pred string, score double")


def _predict_joined(two: DataFrame, model: Slots) -> DataFrame:
    """``predict`` by a filter that is not broadcast: documents are dealt in blocks, and a block's
    distinct n-grams are joined to their slots."""
    known, false, slots, hashes = model.known, model.false, model.slots, model.hashes
    chars = two.agg(F.sum(F.coalesce(F.length("t"), F.lit(0)).cast("long") + ROW_CHARS)).first()[0] or 0
    # the input partition spreads copies of a row; a rerun of its task deals the same
    dealt = two.withColumn("block", F.pmod(F.xxhash64("doc_id", "t", F.spark_partition_id()), F.lit(max(1, -(-chars // BLOCK_CHARS))))) \
        .repartition("block")

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        letters = letter_table()
        held: dict[int, list[np.ndarray]] = {}
        for batch in batches:
            for piece in slices(batch, "t"):
                of = piece.column("block").to_numpy()
                texts = np.array(piece.column("t").to_pylist(), object)
                for block in np.unique(of).tolist():
                    for _, parts in segments(texts[of == block].tolist(), 1, 1):
                        seen = held.setdefault(block, [])
                        seen.append(np.unique(grams(parts, letters)[0]))
                        if sum(map(len, seen)) > HELD_GRAMS:
                            held[block] = [np.unique(np.concatenate(seen))]
        for block, seen in held.items():
            keys = np.unique(np.concatenate(seen))
            for at in range(0, len(keys), 1 << 16):
                k = keys[at:at + (1 << 16)]
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(k), block)), pa.array(k)], ["block", "gram"])

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in slots_of(batch.column("gram").to_numpy(), slots, hashes):
                yield pa.RecordBatch.from_arrays([batch.column("gram"), pa.array(at)], ["gram", "slot"])

    def answer(rows: pa.Table, found: pa.Table) -> pa.Table:
        letters = letter_table()
        plane, by = found.column("plane").to_numpy(), np.argsort(found.column("gram").to_numpy())
        tables = []
        for p in range(max(1, -(-len(known) // 64))):
            own = by[plane[by] == p]
            # the last entry stands for n-grams in no language
            tables.append((found.column("gram").to_numpy()[own],
                           np.append(found.column("mask").to_numpy()[own].view(np.uint64), np.uint64(0))))
        parts_out = []
        for batch in rows.combine_chunks().to_batches():
            for piece in slices(batch, "t"):
                counts = np.zeros(piece.num_rows, np.int64)
                hits = np.zeros((piece.num_rows, max(1, len(known))))
                for number, parts in segments(piece.column("t").to_pylist(), 1, 1):
                    key, n = grams(parts, letters)
                    of = np.repeat(number, n)
                    counts += np.bincount(of, minlength=len(counts))
                    masks = []
                    for keys, mask in tables:
                        at = np.searchsorted(keys, key)
                        there = at < len(keys)
                        there[there] = keys[at[there]] == key[there]
                        masks.append(mask[np.where(there, at, len(keys))])
                    _tally(hits, of, masks)
                parts_out.append(pa.table([piece.column("doc_id"), *_decided(known, false, hits, counts)],
                                          ["doc_id", "lang_pred", "score"]))
        return pa.concat_tables(parts_out) if parts_out else \
            pa.schema([("doc_id", pa.int64()), ("lang_pred", pa.string()), ("score", pa.float64())]).empty_table()
    # an n-gram has at most one row for each block, so none is a large part of them
    asked = dealt.mapInArrow(ask, "block long, gram long").repartition("gram")
    # the filter holds always; it keeps both uses of the n-grams on one exchange
    each = asked.groupBy("gram").agg(F.count("block").alias("blocks")).filter("blocks > 0").select("gram")
    found = each.mapInArrow(spread, "gram long, slot long").join(model.table, "slot").groupBy("gram", "plane") \
        .agg(F.expr("bit_and(mask)").alias("mask"), F.count("*").alias("n")).filter(F.col("n") == hashes)
    answers = asked.join(found, "gram").select("block", "gram", "plane", "mask")
    return dealt.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(
        answer, "doc_id long, lang_pred string, score double")
