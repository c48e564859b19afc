"""Document quality from a linear-chain conditional random field over lines.

Every line is labelled good or bad.  Its features are shares of character
classes, word shapes and repetition, of the line itself and of its two neighbours
(Lafferty et al., ICML 2001, for the model).  With two labels a forward or
backward message is one number, the log odds, so a step of the recursion handles
one line of each document of a slice at once.  The score of a document is the
mean probability of "good" over its lines, weighted by length.

The field is fitted on a bounded sample of labelled documents: ``sample_docs`` of
each label, in pieces of at most ``piece_lines`` lines, at most ``sample_pieces``
pieces; a line's label is its document's.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import slices

SAMPLE_DOCS = 1000
SAMPLE_PIECES = 4000
PIECE_LINES = 64
GROUP_BYTES = 1 << 20          # text whose line features are computed at once
STEPS, RATE, DECAY = 120, 0.2, 1e-3

_UPPER, _LOWER, _DIGIT, _STOP, _MARK, _SPACE, _HIGH = range(7)
_CLASS = np.full(256, _MARK, np.uint8)
_CLASS[0x80:] = _HIGH
for _chars, _k in ((range(65, 91), _UPPER), (range(97, 123), _LOWER), (range(48, 58), _DIGIT),
                   (b".,;:?'\"()-", _STOP), (b" \t\r\x0b\x0c\x00", _SPACE)):
    _CLASS[list(_chars)] = _k
OWN = 13                       # features of a line
WIDTH = 3 * OWN + 3            # with its neighbours, two edge flags and a constant


def groups_of(ends: np.ndarray) -> list[tuple[int, int]]:
    """Ranges of lines of about ``GROUP_BYTES`` bytes; a longer line is one range."""
    cuts = np.unique(np.searchsorted(ends, np.arange(0, ends[-1] + GROUP_BYTES, GROUP_BYTES)))
    cuts = np.unique(np.concatenate([[0], cuts, [len(ends)]]))
    return list(zip(cuts[:-1].tolist(), cuts[1:].tolist()))


def line_features(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(whether each line has more than white space, the OWN features of those lines)."""
    kind = _CLASS[data]
    blank = (kind == _SPACE) | (data == 10)
    seen = np.concatenate([[0], np.cumsum(~blank)])
    full = seen[ends] > seen[starts]
    starts, ends = starts[full], ends[full]
    if not len(starts):
        return full, np.zeros((0, OWN))
    size = (ends - starts).astype(float)

    def total(flags: np.ndarray) -> np.ndarray:
        sums = np.concatenate([[0], np.cumsum(flags, dtype=np.int64)])
        return (sums[ends] - sums[starts]).astype(float)

    by_class = {k: total(kind == k) for k in (_UPPER, _LOWER, _DIGIT, _STOP, _MARK, _SPACE, _HIGH)}
    # words: their bytes' hash tells repeats
    first = np.nonzero(~blank & np.concatenate([[True], blank[:-1]]))[0]
    last = np.nonzero(~blank & np.concatenate([blank[1:], [True]]))[0] + 1
    long = last - first
    begun = np.zeros(len(data), np.int64)
    begun[first] = first
    place = np.arange(len(data)) - np.maximum.accumulate(begun)
    weight = np.uint64(0x9E3779B97F4A7C15) * (2 * place.astype(np.uint64) + np.uint64(1))
    value = np.where(blank, np.uint64(0), (data.astype(np.uint64) + np.uint64(1)) * weight)
    value ^= value >> np.uint64(29)
    word = np.add.reduceat(value, first)
    line = np.searchsorted(ends, first, "right")
    words = np.maximum(1, np.bincount(line, minlength=len(ends))[:len(ends)]).astype(float)
    again = np.zeros(len(word), bool)
    again[1:] = (word[1:] == word[:-1]) & (line[1:] == line[:-1])
    order = np.lexsort((word, line))
    same = np.zeros(len(word), bool)
    same[1:] = (word[order][1:] == word[order][:-1]) & (line[order][1:] == line[order][:-1])
    repeats = np.bincount(line, again, minlength=len(ends))[:len(ends)]
    known = np.bincount(line[order], same & (long[order] > 4), minlength=len(ends))[:len(ends)]
    wide = np.maximum(1, np.bincount(line, long > 4, minlength=len(ends))[:len(ends)])
    marked = np.bincount(line, kind[last - 1] == _MARK, minlength=len(ends))[:len(ends)]
    chars = np.bincount(line, long, minlength=len(ends))[:len(ends)]
    letters = np.maximum(1, by_class[_UPPER] + by_class[_LOWER] + by_class[_HIGH])
    # the last character that is no space
    tail = last[np.searchsorted(first, ends, "left") - 1] - 1
    own = np.column_stack([
        np.log1p(size) / 8, np.log1p(words) / 6, np.minimum(1, chars / words / 16),
        by_class[_UPPER] / letters, by_class[_DIGIT] / size, by_class[_STOP] / size, by_class[_MARK] / size,
        by_class[_SPACE] / size, by_class[_HIGH] / size, repeats / words, known / wide, marked / words,
        kind[tail] == _STOP])
    return full, own


def line_table(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(features (lines, WIDTH), line lengths in bytes, lines of each text).

    Lines end at "\\n"; lines without any character but white space are left out, so null,
    empty and blank texts have no line."""
    raw = [(t or "").encode("utf-8", "surrogatepass") for t in texts]
    data = np.frombuffer(b"\n".join(raw) + b"\n", np.uint8)
    ends = np.nonzero(data == 10)[0]
    starts = np.concatenate([[0], ends[:-1] + 1])
    of = np.searchsorted(np.cumsum([len(r) + 1 for r in raw]), starts, "right")
    parts = [line_features(data[starts[i]:ends[j - 1] + 1], starts[i:j] - starts[i], ends[i:j] - starts[i])
             for i, j in groups_of(ends)]
    full = np.concatenate([f for f, _ in parts])
    own = np.concatenate([x for _, x in parts])
    size, of = (ends - starts)[full].astype(float), of[full]
    counts = np.bincount(of, minlength=len(texts))
    if not len(own):
        return np.zeros((0, WIDTH)), np.zeros(0), counts
    edge = np.zeros((1, OWN))
    begins = np.concatenate([[True], of[1:] != of[:-1]])
    stops = np.concatenate([of[1:] != of[:-1], [True]])
    before = np.where(begins[:, None], 0, np.concatenate([edge, own[:-1]]))
    behind = np.where(stops[:, None], 0, np.concatenate([own[1:], edge]))
    return np.column_stack([own, before, behind, begins, stops, np.ones(len(own))]), size, counts


@dataclass
class Field:
    """weights: log odds of "good" for each (scaled) feature; stay: how much two
    neighbouring lines gain by both being bad, both being good."""
    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    stay: np.ndarray

    def odds(self, x: np.ndarray) -> np.ndarray:
        return ((x - self.mean) / self.scale) @ self.weights

    def messages(self, u: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(forward, backward, first lines): log odds of each line from what stands before it
        and itself, and from what stands behind it."""
        begin = np.cumsum(counts) - counts
        order = np.argsort(-counts, kind="stable")
        begin, counts = begin[order], counts[order]
        steps = int(counts[0]) if len(counts) else 0
        live = np.searchsorted(-counts, -np.arange(1, steps + 1), "right")   # texts with more than t lines
        bad, good = self.stay

        def pass_on(m: np.ndarray) -> np.ndarray:
            return np.logaddexp(0, m + good) - np.logaddexp(bad, m)

        forward, backward = u.copy(), np.zeros_like(u)
        for t in range(1, steps):
            at = begin[:live[t]] + t
            forward[at] += pass_on(forward[at - 1])
        for t in range(steps - 2, -1, -1):
            at = begin[:live[t + 1]] + t
            backward[at] = pass_on(u[at + 1] + backward[at + 1])
        return forward, backward, begin

    def scores(self, texts: list[str | None]) -> np.ndarray:
        """Length-weighted mean of the lines' marginals; 0 for texts without a line."""
        x, size, counts = line_table(texts)
        if not len(x):
            return np.zeros(len(texts))
        forward, backward, _ = self.messages(self.odds(x), counts)
        good = 1 / (1 + np.exp(-np.clip(forward + backward, -500, 500)))
        of = np.repeat(np.arange(len(texts)), counts)
        total = np.bincount(of, size, minlength=len(texts))
        return np.clip(np.bincount(of, size * good, minlength=len(texts)) / np.maximum(total, 1e-300), 0, 1)


def train(pieces: list[tuple[int, np.ndarray]]) -> Field:
    """Maximum likelihood with a quadratic penalty, by Adam steps, on (label, features) of
    pieces.  With one label only, every line gets that label."""
    none = Field(np.zeros(WIDTH), np.ones(WIDTH), np.zeros(WIDTH), np.zeros(2))
    labels = {y for y, _ in pieces}
    if len(labels) < 2:
        none.weights[-1] = 50.0 if labels != {0} else -50.0
        return none
    x = np.concatenate([f for _, f in pieces])
    counts = np.array([len(f) for _, f in pieces])
    y = np.repeat([label for label, _ in pieces], counts).astype(float)
    # both labels weigh the same
    share = np.where(y > 0, 0.5 / max(1, y.sum()), 0.5 / max(1, (1 - y).sum()))
    scale = x.std(axis=0)
    mean = np.where(scale > 0, x.mean(axis=0), 0)
    field = Field(mean, np.where(scale > 0, scale, 1), np.zeros(WIDTH), np.zeros(2))
    z = (x - field.mean) / field.scale
    pair = np.ones(len(y), bool)
    pair[np.cumsum(counts) - 1] = False
    left = np.nonzero(pair)[0]
    first, second = np.zeros(WIDTH + 2), np.zeros(WIDTH + 2)
    for step in range(1, STEPS + 1):
        u = z @ field.weights
        forward, backward, _ = field.messages(u, counts)
        good = 1 / (1 + np.exp(-np.clip(forward + backward, -500, 500)))
        a, b = forward[left], u[left + 1] + backward[left + 1]
        cells = np.stack([field.stay[0] + 0 * a, b, a, a + b + field.stay[1]])   # bad-bad, bad-good, good-bad, good-good
        cells = np.exp(cells - np.logaddexp.reduce(cells, axis=0))
        grad = np.concatenate([z.T @ (share * (y - good)),
                               [(share[left] * (1 - y[left] - cells[0])).sum(), (share[left] * (y[left] - cells[3])).sum()]])
        theta = np.concatenate([field.weights, field.stay])
        grad -= DECAY * theta
        first = 0.9 * first + 0.1 * grad
        second = 0.99 * second + 0.01 * grad * grad
        theta += RATE * (first / (1 - 0.9 ** step)) / (np.sqrt(second / (1 - 0.99 ** step)) + 1e-8)
        field = Field(field.mean, field.scale, theta[:WIDTH], theta[WIDTH:])
    return field


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
        label_col: str = "quality", sample_docs: int = SAMPLE_DOCS, sample_pieces: int = SAMPLE_PIECES,
        piece_lines: int = PIECE_LINES) -> Field:
    """A field fitted on at most ``sample_docs`` labelled documents of each label, chosen by the
    hash of their id.  Labels other than 0 and 1, rows without an id, and documents labelled both
    0 and 1 are not used."""
    known = (labels.select(F.col(id_col).cast("long").alias("doc_id"), F.col(label_col).cast("int").alias("y"))
             .filter("doc_id IS NOT NULL AND y IN (0, 1)").groupBy("doc_id").agg(F.min("y").alias("y"), F.max("y").alias("high"))
             .filter("y = high").drop("high"))
    picked = known.filter("y = 0").orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample_docs).unionByName(
        known.filter("y = 1").orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample_docs))
    two = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("t"))
    # at most 2 * sample_docs ids
    chosen = two.join(F.broadcast(picked), "doc_id").select("doc_id", "y", "t")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, y, text in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "y", "t"))):
                x, _, _ = line_table([text])
                parts = [x[at:at + piece_lines] for at in range(0, len(x), piece_lines)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([row] * len(parts), pa.int64()), pa.array(range(len(parts)), pa.int32()),
                     pa.array([y] * len(parts), pa.int32()),
                     pa.array([p.astype("<f4").tobytes() for p in parts], pa.binary())], ["doc_id", "piece", "y", "x"])
    pieces = chosen.mapInArrow(run, "doc_id long, piece int, y int, x binary") \
        .orderBy(F.xxhash64("doc_id", "piece"), "doc_id", "piece").limit(sample_pieces).collect()
    return train([(p.y, np.frombuffer(p.x, "<f4").reshape(-1, WIDTH).astype(float)) for p in pieces])


def score(docs: DataFrame, field: Field, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: (doc_id, score), the score in 0 to 1 over the whole text.
    Null, empty and blank texts score 0; a repeated row gets a repeated result; an
    empty table gives no row.  Only the text is read for the score."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in slices(batch, "t"):
                got = field.scores(piece.column("t").to_pylist())
                yield pa.RecordBatch.from_arrays([piece.column("doc_id"), pa.array(got)], ["doc_id", "score"])
    two = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("t"))
    return two.mapInArrow(run, "doc_id long, score double")


def keep(docs: DataFrame, field: Field, text_col: str = "text", least: float = 0.5) -> DataFrame:
    """The rows of ``docs`` that score ``least`` or more, all columns as they were."""
    at = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in slices(batch, text_col):
                yield piece.filter(pa.array(field.scores(piece.column(at).to_pylist()) >= least))
    return docs.mapInArrow(run, docs.schema)
