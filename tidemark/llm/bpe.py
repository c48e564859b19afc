"""BPE encoding and decoding with a segment tree over adjacent pair ranks.

A word is a row of leaves, leaf ``i`` holding the rank of the pair (symbol i,
next symbol) together with ``i``; an inner node holds the least of its two
children.  The root therefore is the leftmost lowest-rank merge.  A merge
changes the leaves of at most three symbols, each by a point update along its
path to the root, until the root holds no pair.

Words of one length class are merged side by side: the trees of a whole group of
words are numpy arrays of one level each, and every step merges the root's pair of
each word that still has one.  Words are encoded once per slice of texts.
"""

from __future__ import annotations

import hashlib
import json
import re
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import slices

#: How the tokenizer library's Unicode tables differ from Python's.  Ranges of letters
#: that its word pattern takes for symbols (assigned after its tables were made) ...
LATER = (
    (0x558, 0x558), (0x58B, 0x58C), (0x88F, 0x88F), (0xC5C, 0xC5C), (0xCDC, 0xCDC), (0x208F, 0x208F),
    (0x209D, 0x209F), (0xA7CE, 0xA7CF), (0xA7D2, 0xA7D2), (0xA7D4, 0xA7D4), (0xA7DD, 0xA7DD), (0xA7E2, 0xA7E2),
    (0xA7F1, 0xA7F1), (0xAB6C, 0xAB6D), (0x107BB, 0x107BF), (0x10940, 0x10959), (0x10EC5, 0x10EC7),
    (0x10ED9, 0x10EEE), (0x11B0A, 0x11B0A), (0x11DB0, 0x11DDB), (0x11DF1, 0x11DF1), (0x16EA0, 0x16EB8),
    (0x16EBB, 0x16ED3), (0x16FF2, 0x16FF3), (0x187F8, 0x187FF), (0x18CD6, 0x18CDA), (0x18D09, 0x18D20),
    (0x18D80, 0x18DF2), (0x18E00, 0x19191), (0x191A0, 0x191D2), (0x1B123, 0x1B128), (0x1B168, 0x1B168),
    (0x1D6A6, 0x1D6A6), (0x1DF1F, 0x1DF24), (0x1DF2B, 0x1DF81), (0x1DF90, 0x1DF96), (0x1DFCD, 0x1DFFF),
    (0x1E6C0, 0x1E6DE), (0x1E6E0, 0x1E6E2), (0x1E6E4, 0x1E6E5), (0x1E6E7, 0x1E6ED), (0x1E6F0, 0x1E6F4),
    (0x1E6FE, 0x1E6FF), (0x2B73A, 0x2B73F), (0x2B81E, 0x2B81E), (0x2CEA2, 0x2CEAD), (0x323B0, 0x33479),
    (0x3D000, 0x3FC3F))
#: ... and upper-case letters it lower-cases though ``str.lower`` does not: (first, last, lower of first)
CASED = (
    (0x1C89, 0x1C89, 0x1C8A), (0xA7CB, 0xA7CB, 0x264), (0xA7CC, 0xA7CC, 0xA7CD), (0xA7CE, 0xA7CE, 0xA7CF),
    (0xA7D2, 0xA7D2, 0xA7D3), (0xA7D4, 0xA7D4, 0xA7D5), (0xA7DA, 0xA7DA, 0xA7DB), (0xA7DC, 0xA7DC, 0x19B),
    (0x10D50, 0x10D65, 0x10D70), (0x16EA0, 0x16EB8, 0x16EBB))

NONE = np.int64(1) << 62
GROUP_CELLS = 1 << 18     # leaves of the trees that are merged side by side
CACHE_WORDS = 200_000     # encoded words that a task remembers
PART_CHARS = 1 << 22      # a longer text is encoded in parts, cut at spaces


def byte_alphabet() -> list[str]:
    """The character that stands for each byte: printable Latin-1 for itself, the
    others from U+0100 on, in order."""
    plain = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    other = iter(range(0x100, 0x200))
    return [chr(b) if b in plain else chr(next(other)) for b in range(256)]


class Bpe:
    """Encoder and decoder for a tokenizer file with byte-level symbols, a word-end
    suffix and regular-expression word splitting, as ``word_bpe_49k.json`` has."""

    def __init__(self, spec: dict) -> None:
        model = spec["model"]
        vocab = model["vocab"]
        self.suffix = model["end_of_word_suffix"] or ""
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.tokens = np.empty(max([*vocab.values(), *self.special.values()]) + 1, object)
        for token, i in [*vocab.items(), *self.special.items()]:
            self.tokens[i] = token
        chars = byte_alphabet()
        self.inner = np.array([vocab[c] for c in chars], np.int64)
        self.last = np.array([vocab[c + self.suffix] for c in chars], np.int64)
        merges = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        keys = np.array([(vocab[a] << 32) | vocab[b] for a, b in merges], np.int64)
        joined = np.array([vocab[a + b] for a, b in merges], np.int64)
        order = np.argsort(keys, kind="stable")
        self.keys, self.ranks, self.joined = keys[order], order.astype(np.int64), joined
        split = next(p for p in spec["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split")
        self.pattern = regex.compile(split["pattern"]["Regex"])
        self.later = {c: 0x378 for a, z in LATER for c in range(a, z + 1)}
        self.cased = {a + i: low + i for a, z, low in CASED for i in range(z - a + 1)}
        self.differing = re.compile("[" + "".join(f"{chr(a)}-{chr(z)}" for a, z, *_ in (*LATER, *CASED)) + "]")
        self.cut = regex.compile("(" + "|".join(map(regex.escape, self.special)) + ")") if self.special else None

    def rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of each pair; NONE for pairs that do not merge (or have a side below 0)."""
        key = (left << 32) | right
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where((left >= 0) & (right >= 0) & (self.keys[at] == key), self.ranks[at], NONE)

    def merge(self, symbols: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """Rows of symbols (columns past the length: -1) after all merges; removed
        symbols are -1 in place."""
        rows, width = symbols.shape          # width: a power of two
        bits = max(1, width.bit_length() - 1)
        sym = symbols
        here = np.arange(width)
        after = np.where(here + 1 < lengths[:, None], here + 1, -1)     # next living symbol
        before = np.where(here < lengths[:, None], here - 1, -1)
        beyond = np.concatenate([sym[:, 1:], np.full((rows, 1), -1)], axis=1)
        ranks = self.rank(sym, beyond)
        levels = [np.where(ranks == NONE, NONE, (ranks << bits) | here)]
        while levels[-1].shape[1] > 1:
            levels.append(np.minimum(levels[-1][:, 0::2], levels[-1][:, 1::2]))

        def put(w: np.ndarray, i: np.ndarray, value: np.ndarray) -> None:
            """Point update: leaf i of word w, and its path to the root."""
            levels[0][w, i] = value
            for low, high in zip(levels, levels[1:]):
                i = i >> 1
                high[w, i] = np.minimum(low[w, 2 * i], low[w, 2 * i + 1])

        def leaf(w: np.ndarray, i: np.ndarray) -> np.ndarray:
            """What leaf i holds, given the living symbols."""
            j = after[w, i]
            r = self.rank(sym[w, i], np.where(j >= 0, sym[w, j], -1))
            return np.where(r == NONE, NONE, (r << bits) | i)

        w = np.arange(rows)
        while True:
            root = levels[-1][w, 0]
            live = root < NONE
            w, root = w[live], root[live]
            if not len(w):
                return sym
            i = root & ((1 << bits) - 1)
            j = after[w, i]
            sym[w, i] = self.joined[root >> bits]
            sym[w, j] = -1
            k = after[w, j]
            after[w, i] = k
            has = k >= 0
            before[w[has], k[has]] = i[has]
            put(w, j, np.full(len(w), NONE))
            put(w, i, leaf(w, i))
            h = before[w, i]
            has = h >= 0
            put(w[has], h[has], leaf(w[has], h[has]))

    def encode_words(self, words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(ids, starts, counts): the ids of word ``w`` (already normalized, not empty) are
        ``ids[starts[w]:starts[w] + counts[w]]``."""
        raw = [w.encode("utf-8") for w in words]
        sizes = np.fromiter(map(len, raw), np.int64, len(raw))
        starts, counts, flat_ids, filled_to = np.empty_like(sizes), np.empty_like(sizes), [np.empty(0, "<u4")], 0
        order = np.argsort(sizes, kind="stable")
        at = 0
        while at < len(order):
            width = 1 << int(max(1, sizes[order[at]]) - 1).bit_length()
            rows = max(1, GROUP_CELLS // width)
            group = order[at:at + rows]
            group = group[sizes[group] <= width]
            at += len(group)
            n = sizes[group]
            flat = np.frombuffer(b"".join([raw[i] for i in group.tolist()]), np.uint8)
            symbols = np.full((len(group), width), -1, np.int64)
            symbols[np.arange(width) < n[:, None]] = self.inner[flat]
            symbols[np.arange(len(group)), n - 1] = self.last[flat[np.cumsum(n) - 1]]
            done = self.merge(symbols, n)
            left = done >= 0
            counts[group] = left.sum(axis=1)
            starts[group] = filled_to + np.cumsum(counts[group]) - counts[group]
            flat_ids.append(done[left].astype("<u4"))
            filled_to += len(flat_ids[-1])
        return np.concatenate(flat_ids), starts, counts

    def normalize(self, text: str) -> str:
        """NFC and lower case character by character (no final-sigma rule).  White space
        need not be unified: words never contain any."""
        text = unicodedata.normalize("NFC", text).replace("Σ", "σ")
        return (text.translate(self.cased) if self.odd(text) else text).lower()

    def words(self, text: str) -> list[str]:
        """The words of a normalized text.  Letters that are symbols for the library are
        split as U+0378 is, which no version assigns."""
        if not self.odd(text):
            return self.pattern.findall(text)
        return [text[m.start():m.end()] for m in self.pattern.finditer(text.translate(self.later))]

    def odd(self, text: str) -> bool:
        """Whether a character of ``LATER`` or ``CASED`` may be in the text."""
        try:
            text.encode("latin-1")
        except UnicodeEncodeError:
            return self.differing.search(text) is not None
        return False

    def decode(self, ids: np.ndarray) -> str:
        """Tokens, special ones included, joined by one space."""
        return " ".join(self.tokens[ids].tolist())


class Cache:
    """Ids and token text of the words seen, a bounded number of them at a time."""

    def __init__(self, bpe: Bpe) -> None:
        self.bpe = bpe
        self.clear()

    def clear(self) -> None:
        self.at: dict[str | tuple[str], int] = {}      # word, or special token in a tuple -> number
        self.ids, self.starts, self.counts = np.empty(0, "<u4"), np.empty(0, np.int64), np.empty(0, np.int64)
        self.text: list[str] = []

    def add(self, words: list[str], specials: list[tuple[str]]) -> None:
        ids, starts, counts = self.bpe.encode_words(words)
        more = np.array([self.bpe.special[s] for s, in specials], "<u4")
        starts = np.concatenate([starts, len(ids) + np.arange(len(more))]) + len(self.ids)
        counts = np.concatenate([counts, np.ones(len(more), np.int64)])
        ids = np.concatenate([ids, more])
        tokens = self.bpe.tokens[ids].tolist()
        first = (starts - len(self.ids)).tolist()
        self.text += [" ".join(tokens[s:s + c]) for s, c in zip(first, counts.tolist())]
        self.at.update(zip([*words, *specials], range(len(self.at), len(self.at) + len(counts))))
        self.ids = np.concatenate([self.ids, ids])
        self.starts = np.concatenate([self.starts, starts])
        self.counts = np.concatenate([self.counts, counts])

    def parts(self, text: str) -> Iterator[str]:
        """Parts of a long text.  Neither a word nor a special token nor a composed character
        has a space in it, so the parts encode as the whole does."""
        at = 0
        while at < len(text):
            end = text.find(" ", at + PART_CHARS)
            end = len(text) if end < 0 else end
            yield text[at:end]
            at = end

    def texts(self, texts: list[str]) -> list[tuple[np.ndarray, str]]:
        """(ids, decoded) of each text."""
        if len(texts) == 1 and len(texts[0]) > PART_CHARS and texts[0].find(" ", PART_CHARS) >= 0:
            done = [found for part in self.parts(texts[0]) for found in self.texts([part])]
            return [(np.concatenate([ids for ids, _ in done]), " ".join(t for ids, t in done if len(ids)))]
        bpe = self.bpe
        if len(self.at) > CACHE_WORDS:
            self.clear()
        split = []
        for text in texts:
            words = []
            for k, part in enumerate(bpe.cut.split(text) if bpe.cut and bpe.cut.search(text) else [text]):
                words += [(part,)] if k % 2 else bpe.words(bpe.normalize(part))
            split.append(words)
        fresh = set().union(*split).difference(self.at)
        self.add([w for w in fresh if isinstance(w, str)], [w for w in fresh if not isinstance(w, str)])
        at, text, out = self.at, self.text, []
        for words in split:
            where = [at[w] for w in words]
            k = np.array(where, np.int64)
            n = self.counts[k]
            ends = np.cumsum(n)
            whole = np.arange(ends[-1] if len(k) else 0) + np.repeat(self.starts[k] - ends + n, n)
            out.append((self.ids[whole], " ".join([text[i] for i in where])))
        return out


def load(vocab_path: str) -> Bpe:
    with open(vocab_path, encoding="utf-8") as f:
        return Bpe(json.load(f))


_ENCODED = "doc_id long, ids array<int>, decoded string"
_DIGESTS = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"


def _pieces(batches: Iterator[pa.RecordBatch], spec: bytes) -> Iterator[tuple[pa.Array, list]]:
    cache = Cache(Bpe(json.loads(spec)))
    for batch in batches:
        for piece in slices(batch, "t"):
            yield piece.column("doc_id"), cache.texts([t or "" for t in piece.column("t").to_pylist()])


def _spec(docs: DataFrame, vocab_path: str):
    """The vocabulary file (a fixed size, about 2 MB), read on the driver and broadcast."""
    with open(vocab_path, "rb") as f:
        return docs.sparkSession.sparkContext.broadcast(f.read())


def _two(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("t"))


def encode(docs: DataFrame, vocab_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: (doc_id, ids, decoded) of the whole text.

    Null texts are empty; an empty text has no ids and decodes to ""; a repeated
    row gets a repeated result; an empty table gives no row.  Strings of special
    tokens in a text are those tokens.  Other columns are not read."""
    spec = _spec(docs, vocab_path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, found in _pieces(batches, spec.value):
            yield pa.RecordBatch.from_arrays(
                [ids, pa.array([x.astype(np.int32) for x, _ in found], pa.list_(pa.int32())),
                 pa.array([t for _, t in found], pa.string())], ["doc_id", "ids", "decoded"])
    return _two(docs, id_col, text_col).mapInArrow(run, _ENCODED)


def digests(docs: DataFrame, vocab_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """As ``encode``, but (doc_id, n_tokens, ids_sha256, decoded_sha256): the hashes of the
    ids as little-endian unsigned 32-bit integers and of the decoded UTF-8 text, taken
    where the ids are made, so that no id leaves its task."""
    spec = _spec(docs, vocab_path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sha = hashlib.sha256
        for ids, found in _pieces(batches, spec.value):
            yield pa.RecordBatch.from_arrays(
                [ids, pa.array([len(x) for x, _ in found], pa.int64()),
                 pa.array([sha(x.tobytes()).hexdigest() for x, _ in found], pa.string()),
                 pa.array([sha(t.encode("utf-8")).hexdigest() for _, t in found], pa.string())],
                ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])
    return _two(docs, id_col, text_col).mapInArrow(run, _DIGESTS)
