"""Token counts at every prefix of a text by dynamic programming over tokens.

BPE never makes two tokens side by side that it would not make of their bytes alone, and
a row of tokens of which every two neighbours hold is the encoding of its bytes.  So the
last token of a word's prefix is the one token ending there that holds behind the last token
of what is in front of it, and the prefix's count is that one's count plus one.  Each
distinct word is worked out once per task; a text adds the counts of its words up.

The count at a position is that of the text up to it *as a text of its own*.  The words of
such a text are those of the whole but for the last one, with three exceptions that are
corrected: a run of white space at its end is one word, a contraction may be cut
(``'r`` of ``'re`` is two words), and a special token may be.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.bpe import LATER, byte_alphabet
from tidemark.llm.common import slices

CACHE_WORDS = 300_000     # words whose counts a task remembers
CACHE_PAIRS = 1_000_000   # pairs of tokens of which it remembers whether they hold
PART_CHARS = 1 << 20      # a longer text is counted in parts, cut in front of white space

_SPACE = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
#: the word pattern of the byte-level tokenizer (fixed), white space spelt out
_WORDS = (r"'(?:[stmd]|re|ve|ll)| ?{letter}+| ?{number}+| ?[^{space}{both}]+|[{space}]+(?![^{space}])|[{space}]+")
_CUT_SHORT = ("'re", "'ve", "'ll")


class Prefixes:
    """Counts for a byte-level BPE file such as ``byte_bpe_50k.json``."""

    def __init__(self, spec: dict) -> None:
        as_bytes = str.maketrans({c: chr(b) for b, c in enumerate(byte_alphabet())})     # bytes are written as Latin-1
        model = spec["model"]
        self.ids = {t.translate(as_bytes): i for t, i in model["vocab"].items()}
        self.bytes = {i: t for t, i in self.ids.items()}
        self.rank: dict[tuple[str, str], int] = {}
        for r, m in enumerate(model["merges"]):
            a, b = m if isinstance(m, list) else m.split(" ")
            self.rank[a.translate(as_bytes), b.translate(as_bytes)] = r
        self.made = {a + b: (a, b, r) for (a, b), r in self.rank.items()}
        self.edges: tuple[dict, dict] = {}, {}
        self.longest = {chr(b): 1 for b in range(256)}      # bytes of the longest token that ends in each byte
        for t in self.ids:
            self.longest[t[-1]] = max(self.longest[t[-1]], len(t))
        self.special = [t["content"] for t in spec["added_tokens"]]
        self.cut = re.compile("(" + "|".join(map(re.escape, self.special)) + ")") if self.special else None
        self.ascii = re.compile(_WORDS.format(letter="[A-Za-z]", number="[0-9]", both="A-Za-z0-9", space=r"\t-\r "))
        self.any = regex.compile(_WORDS.format(letter=r"\p{L}", number=r"\p{N}", both=r"\p{L}\p{N}", space=_SPACE))
        self.parts_at = re.compile(f"(?<=[^{_SPACE}])[{_SPACE}]")
        self.blank = re.compile(f"[{_SPACE}]*")
        self.later = {c: 0x378 for a, z in LATER for c in range(a, z + 1)}
        self.differing = re.compile("[" + "".join(f"{chr(a)}-{chr(z)}" for a, z in LATER) + "]")
        self.pairs: dict[tuple[int, int], bool] = {}
        self.clear()

    def clear(self) -> None:
        self.at: dict[str, int] = {}
        self.flat = np.empty(0, np.int32)                                   # counts at every character, word after word
        self.starts, self.chars, self.totals = (np.empty(0, np.int64) for _ in range(3))
        self.is_blank, self.led = np.empty(0, bool), np.empty(0, bool)     # only white space; starts with it

    def merged(self, data: str) -> list[str]:
        """The tokens of a few bytes, merge by merge (lowest rank first, leftmost of equals)."""
        parts = list(data)
        while len(parts) > 1:
            found = [self.rank.get(p, 1 << 30) for p in zip(parts, parts[1:])]
            least = min(found)
            if least == 1 << 30:
                break
            i = found.index(least)
            parts[i:i + 2] = [parts[i] + parts[i + 1]]
        return parts

    def edge(self, token: int, side: int) -> list[tuple[str, int]]:
        """The tokens that stand at the right (1) or left (0) end of a token while it is merged,
        each with the rank of the merge that takes it up."""
        found = self.edges[side].get(token)
        if found is None:
            at, taken, found = self.bytes[token], 1 << 30, []
            while True:
                found.append((at, taken))
                if at not in self.made:
                    break
                taken = self.made[at][2]
                at = self.made[at][side]
            self.edges[side][token] = found
        return found

    def holds(self, left: int, right: int) -> bool:
        """Whether the bytes of two tokens are encoded as these two (``left`` -1: of ``right`` alone, as it).

        They are not if some merge across joins an end of the left to an end of the right before
        both are taken up by their own tokens; of equal ranks the leftmost is merged first."""
        known = self.pairs.get((left, right))
        if known is None:
            if len(self.pairs) > CACHE_PAIRS:
                self.pairs.clear()
            known = self.pairs[left, right] = (not self.crossed(self.edge(left, 1), self.edge(right, 0)) if left >= 0
                                               else self.merged(self.bytes[right]) == [self.bytes[right]])
        return known

    def crossed(self, left: list[tuple[str, int]], right: list[tuple[str, int]]) -> bool:
        rank = self.rank.get
        for x, x_taken in left:
            for y, y_taken in right:
                r = rank((x, y))
                if r is not None and r < x_taken and r <= y_taken:
                    return True
        return False

    def counts(self, words: list[str]) -> Iterator[list[int]]:
        """Tokens of every prefix of each word, the empty one first; bytes are written as
        Latin-1 and the words sorted, so that a word goes on from the prefix it shares with
        the one before it."""
        last, count, before = [-1], [0], ""
        pairs, token_of, longest = self.pairs, self.ids.get, self.longest
        for word in words:
            shared = 0
            for x, y in zip(word, before):
                if x != y:
                    break
                shared += 1
            del last[shared + 1:], count[shared + 1:]
            for end in range(shared + 1, len(word) + 1):
                for begin in range(end - 1, end - 1 - longest[word[end - 1]], -1):
                    token = token_of(word[begin:end])
                    if token is not None:
                        good = pairs.get((last[begin], token))
                        if good or good is None and self.holds(last[begin], token):
                            break
                last.append(token)
                count.append(count[begin] + 1)
            before = word
            yield count

    def add(self, words: list[str]) -> None:
        """Remember the counts of new words at the end of each of their characters."""
        if not words:
            return
        raw = [w if w.isascii() else w.encode("utf-8").decode("latin-1") for w in words]
        order = sorted(range(len(words)), key=raw.__getitem__)
        words, raw = [words[i] for i in order], [raw[i] for i in order]
        every, sizes, totals = [], [], []
        for word, written, found in zip(words, raw, self.counts(raw)):
            if len(written) != len(word):
                ends = [i for i in range(1, len(written)) if ord(written[i]) & 0xC0 != 0x80] + [len(written)]
                every += [found[i] for i in ends]
            elif word in _CUT_SHORT:
                every += [found[1], 2, found[3]]
            else:
                every += found[1:]
            sizes.append(len(word))
            totals.append(found[-1])
        sizes = np.array(sizes, np.int64)
        starts = len(self.flat) + np.cumsum(sizes) - sizes
        self.at.update(zip(words, range(len(self.at), len(self.at) + len(words))))
        self.flat = np.concatenate([self.flat, np.array(every, np.int32)])
        self.starts, self.chars = np.concatenate([self.starts, starts]), np.concatenate([self.chars, sizes])
        self.totals = np.concatenate([self.totals, np.array(totals, np.int64)])
        self.is_blank = np.concatenate([self.is_blank, [self.blank.fullmatch(w) is not None for w in words]])
        self.led = np.concatenate([self.led, [self.blank.match(w).end() > 0 for w in words]])

    def words(self, text: str) -> list[str]:
        if text.isascii():
            return self.ascii.findall(text)
        if self.differing.search(text):
            return [text[m.start():m.end()] for m in self.any.finditer(text.translate(self.later))]
        return self.any.findall(text)

    def ordinary(self, texts: list[str]) -> list[np.ndarray]:
        """Counts at positions 1, 2, ... of each text, special tokens taken as plain text."""
        if len(self.at) > CACHE_WORDS:
            self.clear()
        split = [self.words(t) for t in texts]
        self.add(list(set().union(*split).difference(self.at)))
        found = [np.fromiter(map(self.at.__getitem__, words), np.int64, len(words)) for words in split]
        # a text that ends behind a run of white space has the run as one word
        cut = [np.flatnonzero(self.is_blank[k[:-1]] & self.led[k[1:]]) for k in found]
        runs = [[words[i] + words[i + 1][0] for i in at.tolist()] for words, at in zip(split, cut)]
        self.add(list(set().union(*runs).difference(self.at)))
        out = []
        for k, at, blanks in zip(found, cut, runs):
            n, totals = self.chars[k], self.totals[k]
            ends, base = np.cumsum(n), np.cumsum(totals) - totals
            size = int(ends[-1]) if len(k) else 0
            counts = self.flat[np.arange(size) + np.repeat(self.starts[k] - ends + n, n)] + np.repeat(base, n)
            if blanks:
                counts[ends[at]] = base[at] + self.totals[[self.at[b] for b in blanks]]
            out.append(counts)
        return out

    def parts(self, text: str, limit: int = 0) -> Iterator[str]:
        """A long text in parts.  No word goes on from a character into white space, so the
        words of the parts are those of the text."""
        limit = limit or PART_CHARS
        begin = 0
        while len(text) - begin > limit:
            cut = self.parts_at.search(text, begin + limit)
            if not cut:
                break
            yield text[begin:cut.start()]
            begin = cut.start()
        yield text[begin:]

    def texts(self, texts: list[str]) -> Iterator[Iterator[np.ndarray]]:
        """For each text its counts at positions 1, 2, ..., in consecutive arrays."""
        plain = [t for t in texts if len(t) <= PART_CHARS and not (self.cut and self.cut.search(t))]
        ready = iter(self.ordinary(plain))
        for text in texts:
            if len(text) <= PART_CHARS and not (self.cut and self.cut.search(text)):
                yield iter([next(ready)])
            else:
                yield self._long(text)

    def _long(self, text: str) -> Iterator[np.ndarray]:
        base = 0
        pieces = self.cut.split(text) if self.cut else [text]
        for i in range(0, len(pieces), 2):
            front, behind = base, None
            for part in self.parts(pieces[i]):
                if part:
                    front = base
                    found, = self.ordinary([part])
                    yield found + base
                    base += int(found[-1])
                    behind = part
            if i + 1 < len(pieces):     # cut within the special token, it is plain text behind the last part
                special = pieces[i + 1]
                whole, = self.ordinary([(behind or "") + special[:-1]])
                inside = whole[len(behind or ""):] + front
                base += 1
                yield np.append(inside, base)


def load(vocab_path: str) -> Prefixes:
    with open(vocab_path, encoding="utf-8") as f:
        return Prefixes(json.load(f))


def _spec(docs: DataFrame, vocab_path: str):
    """The vocabulary file (a fixed size, about 2 MB), read on the driver and broadcast."""
    with open(vocab_path, "rb") as f:
        return docs.sparkSession.sparkContext.broadcast(f.read())


def _two(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(text_col, F.lit("")).alias("t"))


def prefix_counts(docs: DataFrame, vocab_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, start, counts): ``counts[i]`` tokens has the text up to ``start + i + 1`` characters.

    One row per part of about a million characters of a row of ``docs``; an empty or null
    text has one row without counts, a repeated row has its rows again, an empty table gives
    none.  Other columns are not read."""
    spec = _spec(docs, vocab_path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = Prefixes(json.loads(spec.value))
        for batch in batches:
            for piece in slices(batch, "t"):
                for doc, parts in zip(piece.column("doc_id"), table.texts(piece.column("t").to_pylist())):
                    start = 0
                    for found in parts:
                        yield pa.RecordBatch.from_arrays(
                            [pa.array([doc.as_py()], pa.int64()), pa.array([start], pa.int64()),
                             pa.array([found], pa.list_(pa.int64()))], ["doc_id", "start", "counts"])
                        start += len(found)
    return _two(docs, id_col, text_col).mapInArrow(run, "doc_id long, start long, counts array<long>")


def token_counts(docs: DataFrame, vocab_path: str, limit: int = 512, id_col: str = "doc_id",
                 text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: (doc_id, n_bytes, n_tokens, over_limit, fits, cut_bytes).

    ``fits``: the characters of the longest prefix that has at most ``limit`` tokens,
    ``cut_bytes`` its bytes, both read from the counts at every prefix (a longer prefix may
    have fewer tokens).  Null texts are empty, an empty text has no tokens; repeated rows
    get repeated results; an empty table gives no row.  Other columns are not read."""
    spec = _spec(docs, vocab_path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = Prefixes(json.loads(spec.value))
        for batch in batches:
            for piece in slices(batch, "t"):
                texts = piece.column("t").to_pylist()
                tokens, fits = [], []
                for parts in table.texts(texts):
                    start = last = fit = 0
                    for found in parts:
                        if len(found):
                            last = int(found[-1])
                            within = np.flatnonzero(found <= limit)
                            fit = start + int(within[-1]) + 1 if len(within) else fit
                            start += len(found)
                    tokens.append(last)
                    fits.append(fit)
                sizes = [len(t.encode("utf-8")) for t in texts]
                yield pa.RecordBatch.from_arrays(
                    [piece.column("doc_id"), pa.array(sizes, pa.int64()), pa.array(tokens, pa.int64()),
                     pa.array([n > limit for n in tokens], pa.bool_()), pa.array(fits, pa.int64()),
                     pa.array([b if f == len(t) else len(t[:f].encode("utf-8")) for t, f, b in zip(texts, fits, sizes)], pa.int64())],
                    ["doc_id", "n_bytes", "n_tokens", "over_limit", "fits", "cut_bytes"])
    return _two(docs, id_col, text_col).mapInArrow(
        run, "doc_id long, n_bytes long, n_tokens long, over_limit boolean, fits long, cut_bytes long")


def truncate(docs: DataFrame, counts: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with every text cut to its longest prefix within the limit of ``counts``
    (``token_counts`` of these documents, ids not repeated), without encoding anything again."""
    told = counts.select(F.col("doc_id").alias("__id"), F.col("fits").cast("int").alias("__fits"))
    return (docs.join(told.hint("merge"), docs[id_col] == told["__id"], "left")
            .withColumn(text_col, F.when(F.col("__fits").isNotNull(), F.substring(text_col, F.lit(1), F.col("__fits")))
                        .otherwise(F.col(text_col))).select(*docs.columns))
