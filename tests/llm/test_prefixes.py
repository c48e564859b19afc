"""Counts at every prefix against the tokenizers library."""

import random

import numpy as np
import pytest

from tidemark.llm import prefixes, queries

PATH = queries.tokenizer_path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def count():
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(PATH)
    return lambda text: len(t.encode(text, add_special_tokens=False).ids)


@pytest.fixture(scope="module")
def table():
    return prefixes.load(PATH)


def texts():
    rnd = random.Random(3)
    out = ["I'll go, we're", "'re", "x  y", "  ", "a\n\nb", "a \n b", "<|endoftext|>", "a <|endoftext|> b", "a  <|endoftext|>",
           "'<|endoftext|><|endoftext|>", "!'s 'll", "-" * 150 + " = = ====", "é ü 你好 🎉", " don't  you've", "a\x1cb\x85c  d"]
    out += ["".join(rnd.choice("abcdefthe 'slrdvm.,!12é\n \t<|>") for _ in range(rnd.randrange(1, 60))) for _ in range(120)]
    out += ["".join(rnd.choice(["<|endoftext|>", "'re", " the", "  ", "'", "re", "\n\n", "--", "===", " ", "ll", "'ll", " "])
                    for _ in range(rnd.randrange(1, 25))) for _ in range(120)]
    return out


def whole(table, text):
    parts = [*next(table.texts([text]))]
    return np.concatenate(parts).tolist() if parts else []


def test_every_prefix(table, count):
    for text in texts():
        assert whole(table, text) == [count(text[:i]) for i in range(1, len(text) + 1)], text


def test_parts_and_caches_change_nothing(monkeypatch, count):
    monkeypatch.setattr(prefixes, "PART_CHARS", 15)
    monkeypatch.setattr(prefixes, "CACHE_WORDS", 10)
    monkeypatch.setattr(prefixes, "CACHE_PAIRS", 10)
    small = prefixes.load(PATH)
    for text in texts()[::3]:
        assert whole(small, text) == [count(text[:i]) for i in range(1, len(text) + 1)], text
        assert len(small.pairs) <= 11


def test_every_code_point(table, count):
    for c in [c for c in range(0x30000) if not 0xD800 <= c < 0xE000][::7]:
        text = f"a{chr(c)}1{chr(c)} {chr(c)}{chr(c)}.b"
        assert table.ordinary([text])[0][-1] == count(text), hex(c)


def test_last_token_is_the_only_one_that_holds(table):
    """Exactly one token that ends at a prefix's end holds behind the last token in front of it."""
    rnd = random.Random(2)
    for _ in range(200):
        word = "".join(rnd.choice("aeinorst dhl") for _ in range(rnd.randrange(1, 12)))
        last = [-1]
        for end in range(1, len(word) + 1):
            found = [i for b in range(end) if (i := table.ids.get(word[b:end])) is not None and table.holds(last[b], i)]
            assert len(found) == 1
            last.append(found[0])


def test_pairs_hold_as_merging_their_bytes_says(table):
    rnd = random.Random(1)
    runs = [i for i, t in table.bytes.items() if len(set(t)) == 1]
    every = sorted(table.bytes)
    for n in range(30_000):
        pool = (every, runs)[n % 2]
        a, b = rnd.choice(pool), rnd.choice(pool)
        assert table.holds(a, b) == (table.merged(table.bytes[a] + table.bytes[b]) == [table.bytes[a], table.bytes[b]])


def test_query_and_odd_rows(spark, count, tmp_path):
    rows = [(1, "Hello world", 3), (2, None, 3), (3, "", 3), (None, "x", None), (1, "Hello world", 3), (4, "word é " * 200, 0),
            (5, "qz" * 600, 0)]
    df = spark.createDataFrame(rows, "doc_id long, text string, t int")
    df.write.parquet(str(tmp_path / "documents.parquet"))
    got = sorted((tuple(r) for r in queries.op12_token_counts(spark, str(tmp_path)).collect()), key=str)
    expect = []
    for doc, text, _ in rows:
        text = text or ""
        n = count(text)
        fits = len(text)
        while n > 512 and fits and count(text[:fits]) > 512:
            fits -= 1
        expect.append((doc, len(text.encode()), n, n > 512, fits, len(text[:fits].encode())))
    assert got == sorted(expect, key=str)
    parts = {(r.doc_id, r.start): r.counts for r in prefixes.prefix_counts(df.filter("doc_id < 4"), PATH).collect()}
    assert parts[2, 0] == parts[3, 0] == [] and parts[1, 0] == [count("Hello world"[:i]) for i in range(1, 12)]
    short = prefixes.truncate(df, prefixes.token_counts(df.filter("doc_id > 1"), PATH, limit=7)).collect()
    assert {r.doc_id: r.text for r in short}[4] == "word é word é "[:13] or count({r.doc_id: r.text for r in short}[4]) <= 7
    assert len(short) == 7 and prefixes.token_counts(df.limit(0), PATH).collect() == []
