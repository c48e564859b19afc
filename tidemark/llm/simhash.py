"""SimHash near-duplicate groups by tiled exact comparison.

1. ``fingerprints``: one 64-bit fingerprint per text (Charikar, STOC 2002).
2. Equal fingerprints collapse before anything is compared, so a group of
   copies of any size is one fingerprint.
3. Fingerprints are put in cells by the bit counts of their four 16-bit parts
   and a cell is cut in tiles of at most ``tile_rows``.  |popcount(x) -
   popcount(y)|, summed over the parts, is a lower bound of the Hamming
   distance, so a pair of tiles whose counts differ by more than the radius is
   never formed.  About 5 % of all pairs remain; none of the links is lost.
4. Each remaining pair of tiles is compared whole with numpy exclusive-or and
   bit counts.  Of the links found a task keeps a spanning forest per pair of
   tiles, so dense groups give a row per fingerprint and not per link.
5. Star contraction joins the forests to components.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import cut, row_hashes, slices
from tidemark.llm.components import components

SHINGLE_WORDS = 3
RADIUS = 3
SEED = 42
PARTS, PART_BITS = 4, 16
TILE_ROWS = 4096
STRIP_ROWS = 256
BITS_AT_ONCE = 1 << 15
LIST_BYTES = 1 << 20       # text whose words are held at once
_SPACE = re.compile(rb"[\x20\x09-\x0d]")


def word_lists(data: bytes, limit: int = 0) -> Iterator[list[bytes]]:
    """The words of ``data`` in lists of about ``limit`` bytes of text."""
    at, limit = 0, limit or LIST_BYTES
    while at < len(data):
        space = _SPACE.search(data, at + limit)
        end = space.start() if space else len(data)
        yield data[at:end].split()      # ASCII white space only
        at = end


def fingerprint(text: str | None, shingle_words: int = SHINGLE_WORDS) -> int:
    """64-bit SimHash of the lower-cased (A-Z) word shingles, repeats included.
    Null, empty or blank text: 0.  Fewer words than a shingle: one shingle of all words."""
    digest = xxhash.xxh64_intdigest
    ones, total, carried = np.zeros(64, np.int64), 0, []

    def add(grams) -> int:
        hashes = np.fromiter((digest(g, SEED) for g in grams), np.uint64)
        for at in range(0, len(hashes), BITS_AT_ONCE):
            part = hashes[at:at + BITS_AT_ONCE].astype("<u8").view(np.uint8).reshape(-1, 8)
            ones[:] += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
        return len(hashes)
    for words in word_lists((text or "").encode("utf-8").lower()):
        words = carried + words
        total += add(map(b" ".join, zip(*(words[i:] for i in range(shingle_words)))))
        carried = words[max(0, len(words) - shingle_words + 1):] if len(words) >= shingle_words else words
    if not total and carried:
        total = add([b" ".join(carried)])
    return int(np.packbits(2 * ones > total, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 shingle_words: int = SHINGLE_WORDS, carry: tuple[str, ...] = ()) -> DataFrame:
    """(doc_id, fp) and the bigint columns ``carry``: ``fp`` is the fingerprint as a signed bigint."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in slices(batch, "t"):
                fps = np.array([fingerprint(t, shingle_words) for t in piece.column("t").to_pylist()],
                               np.uint64).view(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [piece.column("doc_id").cast(pa.int64()), pa.array(fps), *(piece.column(c) for c in carry)],
                    ["doc_id", "fp", *carry])
    two = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("t"), *carry)
    return two.mapInArrow(run, ", ".join(["doc_id long", "fp long", *(f"{c} long" for c in carry)]))


def forest(a: np.ndarray, b: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Spanning forest of the links between two arrays of distinct fingerprints
    (or within one, when ``b`` is ``a``), as pairs of values.

    Rows are compared in strips; after each strip the labels of what it
    linked are merged, so memory stays at one strip whatever the number of links."""
    values = a if b is a else np.concatenate([a, b])
    shift = 0 if b is a else len(a)
    label = np.arange(len(values))
    for at in range(0, len(a), STRIP_ROWS):
        near = np.bitwise_count(a[at:at + STRIP_ROWS, None] ^ b[None, :]) <= radius
        i, j = np.nonzero(near)
        if not len(i):
            continue
        i, j = i + at, j + shift
        while True:
            li, lj = label[i], label[j]
            if np.array_equal(li, lj):
                break
            np.minimum.at(label, np.maximum(li, lj), np.minimum(li, lj))
            while True:   # every label points to its root
                up = label[label]
                if np.array_equal(up, label):
                    break
                label = up
    moved = np.nonzero(label != np.arange(len(values)))[0]
    return values[moved], values[label[moved]]


def _part_counts(fp) -> list:
    mask = (1 << PART_BITS) - 1
    return [F.bit_count(F.shiftrightunsigned(fp, PART_BITS * p).bitwiseAND(F.lit(mask)))
            for p in range(PARTS)]


def _offsets(radius: int) -> list[int]:
    """Differences between the keys of two cells whose counts are within the
    radius, one of each pair of opposite ones (and 0)."""
    found = [[]]
    for _ in range(PARTS):
        found = [f + [d] for f in found for d in range(-radius, radius + 1)
                 if sum(map(abs, f)) + abs(d) <= radius]
    return [sum(d * 64 ** p for p, d in enumerate(f)) for f in found
            if next((d for d in reversed(f) if d), 0) >= 0]


def links(fps: DataFrame, radius: int = RADIUS, tile_rows: int = TILE_ROWS) -> DataFrame:
    """Distinct fingerprints ``fp`` -> links (u, v) that connect exactly those
    groups which links of at most ``radius`` differing bits connect."""
    counts = _part_counts(F.col("fp"))
    key = sum((c.cast("long") * 64 ** p for p, c in enumerate(counts[1:], 1)), counts[0].cast("long"))
    cells = fps.select("fp", key.alias("cell"))
    # at most 17**4 = 83,521 cells, whatever the data
    sizes = cells.groupBy("cell").agg(F.ceil(F.count(F.lit(1)) / tile_rows).cast("int").alias("slots"))
    tiled = (cells.join(F.broadcast(sizes), "cell")
             .withColumn("slot", F.pmod(F.xxhash64("fp"), F.col("slots")).cast("int")))
    tiles = cut(tiled.groupBy("cell", "slot").agg(F.collect_list("fp").alias("fps")))
    names = tiles.select("cell", "slot")
    left = names.select(F.col("cell").alias("cell_a"), F.col("slot").alias("slot_a"),
                        F.explode(F.array(*[F.lit(o) for o in _offsets(radius)])).alias("off"))
    pairs = (left.select("cell_a", "slot_a", (F.col("cell_a") + F.col("off")).alias("cell_b"))
             .join(names.select(F.col("cell").alias("cell_b"), F.col("slot").alias("slot_b")), "cell_b")
             .filter("cell_a != cell_b OR slot_a <= slot_b"))
    met = (pairs.join(tiles.select(F.col("cell").alias("cell_a"), F.col("slot").alias("slot_a"),
                                   F.col("fps").alias("a")), ["cell_a", "slot_a"])
           .join(tiles.select(F.col("cell").alias("cell_b"), F.col("slot").alias("slot_b"),
                              F.col("fps").alias("b")), ["cell_b", "slot_b"])
           .select(((F.col("cell_a") == F.col("cell_b")) & (F.col("slot_a") == F.col("slot_b"))).alias("same"),
                   "a", "b"))

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def column(arr):
            arr = arr.combine_chunks() if isinstance(arr, pa.ChunkedArray) else arr
            return arr.flatten().to_numpy().view(np.uint64), np.concatenate([[0], np.cumsum(arr.value_lengths())])
        for batch in batches:
            us, vs = [], []
            a, ao = column(batch.column("a"))
            b, bo = column(batch.column("b"))
            for k, same in enumerate(batch.column("same").to_pylist()):
                x = a[ao[k]:ao[k + 1]]
                u, v = forest(x, x if same else b[bo[k]:bo[k + 1]], radius)
                if len(u):
                    us.append(u)
                    vs.append(v)
            none = [np.empty(0, np.uint64)]
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x or none).view(np.int64)) for x in (us, vs)],
                                             ["u", "v"])
    return met.mapInArrow(compare, "u long, v long")


def groups(fps: DataFrame, radius: int = RADIUS, tile_rows: int = TILE_ROWS) -> DataFrame:
    """(doc_id, fp) -> (fp, root, component_id): the smallest doc_id that links of at most
    ``radius`` bits reach (null when no document there has an id); ``root`` names the
    component in any case."""
    firsts = cut(fps.groupBy("fp").agg(F.min("doc_id").alias("first_id")))
    found = components(links(firsts.select("fp"), radius, tile_rows))
    rooted = firsts.join(found.withColumnRenamed("node", "fp"), "fp", "left") \
        .withColumn("root", F.coalesce("root", "fp"))
    least = rooted.groupBy("root").agg(F.min("first_id").alias("component_id"))
    return rooted.join(least, "root").select("fp", "root", "component_id")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    shingle_words: int = SHINGLE_WORDS, radius: int = RADIUS,
                    tile_rows: int = TILE_ROWS) -> DataFrame:
    """One row per row of ``docs``: (doc_id, fingerprint, component_id).

    ``fingerprint`` is 16 lower-case hex digits.  Null, empty and blank texts
    share fingerprint zero and are linked like any other; a repeated row gets a
    repeated result; rows without an id take part in no minimum but get the
    component of their fingerprint; an empty table gives no row.  Other columns
    of ``docs`` are not read."""
    fps = cut(fingerprints(docs, id_col, text_col, shingle_words))
    return (fps.join(groups(fps, radius, tile_rows), "fp")
            .select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"))


def one_per_group(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  shingle_words: int = SHINGLE_WORDS, radius: int = RADIUS) -> DataFrame:
    """One row of every group, all columns as they were: the one of smallest id, rows without an id
    last; of several such rows the one whose hash over all columns is smallest.  So every group
    keeps exactly one row, also where ids repeat or are missing, and a rerun keeps the same."""
    keyed = row_hashes(docs)
    fps = cut(fingerprints(keyed, id_col, text_col, shingle_words, ("__h1", "__h2")))
    found = groups(fps.select("doc_id", "fp"), radius, tile_rows=TILE_ROWS)
    row = F.struct(F.col("doc_id").isNull(), "doc_id", "__h1", "__h2")
    keep = (fps.join(found.select("fp", "root"), "fp").groupBy("root").agg(F.min(row).alias("r"))
            .select(F.col("r.__h1").alias("__k1"), F.col("r.__h2").alias("__k2")))
    kept = keyed.join(keep.hint("merge"), (F.col("__h1") == F.col("__k1")) & (F.col("__h2") == F.col("__k2")), "left_semi")
    return kept.dropDuplicates(["__h1", "__h2"]).select(*[F.col(f"`{c}`") for c in docs.columns])     # equal rows
