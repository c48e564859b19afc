"""Ids and decoded text against the tokenizers library."""

import hashlib
import random

import duckdb
import numpy as np
import pytest

from tests.conftest import SF_SMALL
from tidemark.llm import bpe, queries


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(queries.tokenizer_path())
    t.no_truncation()
    t.no_padding()
    return t


def texts():
    rnd = random.Random(4)
    out = [r[0] for r in duckdb.connect().execute(f"SELECT text FROM '{SF_SMALL}/documents.parquet'").fetchall()]
    out += ["", "   ", "it's we'll THEY'RE I'D", "ΣΑΣ ΟΔΥΣΣΕΥΣ", "İstanbul Kelvin", "a<|endoftext|>b <|startoftext|>C <|EndOfText|>",
            "<|endoftext|>", "x" * 5000, "ab" * 3000 + "!" * 2000, "é é", "你好世界 12345 ٣٤٥ ½", "🎉🎉👨‍👩‍👧 ok",
            "\x1c\x1d\x1e\x1fq\x85r\xa0s​t᠎u　v"]
    out += ["".join(rnd.choice("abcdefthe 'slrd.,!12éñ\n") for _ in range(rnd.randrange(1, 300))) for _ in range(300)]
    return out


def test_encode_and_decode_match_the_library(library):
    all_texts = texts()
    cache = bpe.Cache(bpe.load(queries.tokenizer_path()))
    for text, (ids, decoded) in zip(all_texts, cache.texts(all_texts)):
        expect = library.encode(text, add_special_tokens=False).ids
        assert ids.tolist() == expect, text[:80]
        assert decoded == library.decode(expect, skip_special_tokens=False)


def test_every_code_point(library):
    cache = bpe.Cache(bpe.load(queries.tokenizer_path()))
    for block in range(0, 0x40000, 0x1000):
        asked = [f"a{chr(c)}b" for c in range(block, block + 0x1000) if not 0xD800 <= c < 0xE000]
        expect = library.encode_batch(asked, add_special_tokens=False)
        for text, (ids, _), e in zip(asked, cache.texts(asked), expect):
            assert ids.tolist() == e.ids, ascii(text)


def test_cache_is_bounded(monkeypatch, library):
    monkeypatch.setattr(bpe, "CACHE_WORDS", 10)
    monkeypatch.setattr(bpe, "GROUP_CELLS", 32)
    monkeypatch.setattr(bpe, "PART_CHARS", 40)     # long texts in parts
    model = bpe.load(queries.tokenizer_path())
    small = bpe.Cache(model)
    for text in [*texts()[:30], "<|endoftext|> e\u0301 " * 20, " " * 200, "x" * 300]:
        (a, b), = small.texts([text])
        c = library.encode(text, add_special_tokens=False).ids
        assert a.tolist() == c and b == library.decode(c, skip_special_tokens=False)
        assert len(small.at) <= 10 + len(set(text.split())) * 3 + 10


def test_tree_root_is_leftmost_lowest_rank(monkeypatch):
    """Merging word by word in plain Python gives the same symbols."""
    model = bpe.load(queries.tokenizer_path())
    rank = {int(k): (int(r), int(model.joined[r])) for k, r in zip(model.keys, model.ranks)}

    def plain(word):
        raw = word.encode()
        s = [*model.inner[np.frombuffer(raw[:-1], np.uint8)].tolist(), int(model.last[raw[-1]])]
        while True:
            pairs = [(rank[(a << 32) | b][0], i) for i, (a, b) in enumerate(zip(s, s[1:])) if (a << 32) | b in rank]
            if not pairs:
                return s
            _, i = min(pairs)
            s[i:i + 2] = [rank[(s[i] << 32) | s[i + 1]][1]]
    rnd = random.Random(1)
    words = ["".join(rnd.choice("aabcdetghinors") for _ in range(rnd.randrange(1, 40))) for _ in range(500)] + ["a", "é", "aaaa"]
    ids, starts, counts = model.encode_words(words)
    for w, s, n in zip(words, starts, counts):
        assert ids[s:s + n].tolist() == plain(w), w


def test_query_columns_and_odd_rows(spark, library, tmp_path):
    rows = [(1, "Hello world", 3), (2, None, 3), (3, "", 3), (None, "x", None), (1, "Hello world", 3)]
    spark.createDataFrame(rows, "doc_id long, text string, n_tokens int").write.parquet(str(tmp_path / "documents.parquet"))
    got = queries.op3_bpe_roundtrip(spark, str(tmp_path)).collect()
    assert len(got) == 5
    for r, text in ((next(g for g in got if g.doc_id == i), t) for i, t in ((1, "Hello world"), (2, ""), (3, ""), (None, "x"))):
        ids = library.encode(text, add_special_tokens=False).ids
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(library.decode(ids, skip_special_tokens=False).encode()).hexdigest()
    df = spark.createDataFrame(rows, "doc_id long, text string, n_tokens int")
    full = {r.doc_id: (r.ids, r.decoded) for r in bpe.encode(df, queries.tokenizer_path()).collect()}
    assert full[1] == (library.encode("Hello world").ids, "hello</w> world</w>") and full[3] == ([], "")
    assert bpe.encode(df.limit(0), queries.tokenizer_path()).collect() == []
