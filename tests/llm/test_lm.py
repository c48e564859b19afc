"""Losses against two models kept in plain dictionaries."""

import math
import random
from collections import Counter

import pytest

from tidemark.llm import chars, lm, queries

SF = "/root/testdata/sf0.001"


def units(text):
    """The UTF-16 units of a lower-cased text, one character each."""
    raw = (text or "").lower().encode("utf-16-be")
    return "".join(chr(int.from_bytes(raw[i:i + 2], "big")) for i in range(0, len(raw), 2))


def plain_grams(text):
    s = "\0" * lm.LEAD + units(text)
    return [[s[i - n:i + 1] for n in range(lm.LEAD + 1)] for i in range(lm.LEAD, len(s))]


def plain_model(texts, scale):
    grams, before = Counter(), Counter()
    for t in texts:
        for by_order in plain_grams(t):
            for n, g in enumerate(by_order):
                grams[n, g] += scale
                if n:
                    before[n, g[:-1]] += scale
    return grams, before


def plain_loss(model, tokens, kinds, text):
    grams, before = model
    total = 0.0
    for by_order in plain_grams(text):
        p = (grams[0, by_order[0]] + 1) / (tokens + kinds)
        for n, g in enumerate(by_order[1:], 1):
            p = (grams[n, g] + lm.MU * p) / (before[n, g[:-1]] + lm.MU)
        total -= math.log2(p)
    return total / max(1, len(units(text)))


@pytest.mark.parametrize("segment", [1 << 20, 5])
def test_scores_match_plain_models(spark, monkeypatch, segment):
    monkeypatch.setattr(chars, "SEGMENT_CHARS", segment)
    target = ["the cat sat on the mat", "the dog sat", None]
    background = ["zwölf Boxkämpfer jagen Viktor", "the cat sat on the mat", "", "quer über den großen Deich", "THE DOG",
                  "\U0001F600\U0001F601 the \U0002F600"]
    asked = ["the mat", "\U0001F601\U0001F600 the \U0001F600", "\U0002F601", "a\U00010428\U00010400b", "Zwölf Boxer", "", None, "日本 the", "q", "the cat sat on the mat" * 50]
    frame = lambda ts: spark.createDataFrame([(i, t, 7) for i, t in enumerate(ts)], "doc_id long, text string, cell int")
    models = lm.fit(frame(target), frame(background))
    got = {r.doc_id: r for r in lm.score(frame(asked), models).collect()}
    t, b = (sum(len(units(x)) for x in ts) for ts in (target, background))
    matched, kinds = min(t, b), len(set("".join(map(units, target + background)))) + 1
    plain_t, plain_b = plain_model(target, matched / t), plain_model(background, matched / b)
    for i, text in enumerate(asked):
        assert got[i].n_tokens == len(units(text))
        lt, lb = plain_loss(plain_t, matched, kinds, text), plain_loss(plain_b, matched, kinds, text)
        assert abs(got[i].loss_target - lt) < 1e-4 and abs(got[i].loss_background - lb) < 1e-4
        assert abs(got[i].score - (lt - lb)) < 1e-4


def test_nothing_to_learn_from(spark):
    df = spark.createDataFrame([(1, "abc"), (None, None)], "doc_id long, text string")
    models = lm.fit(df.limit(0), df.limit(0))
    got = {r.doc_id: (r.n_tokens, r.score) for r in lm.score(df, models).collect()}
    assert got == {1: (3, 0.0), None: (0, 0.0)}
    assert lm.score(df.limit(0), models).collect() == []


def test_query_prefers_what_the_target_has(spark):
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    got = queries.op7_lm_score(spark, "/root/testdata/sf0.01")
    assert got.count() == 1000
    by = {(r.quality, r.toxic): r["avg(score)"] for r in got.join(labels, "doc_id").groupBy("quality", "toxic").avg("score").collect()}
    assert by[1, 0] < by[1, 1] < by[0, 0]


def test_many_ngrams_stay_apart(spark):
    """More distinct n-grams than any fixed table of cells keeps apart, and small blocks of documents."""
    rnd = random.Random(7)
    letters = [chr(c) for c in range(0x4E00, 0x4E00 + 5000)]
    write = lambda n: "".join(rnd.choice(letters) for _ in range(n))
    target, background = [write(2000) for _ in range(100)], [write(2000) for _ in range(400)]
    frame = lambda ts: spark.createDataFrame(list(enumerate(ts)), "doc_id long, text string")
    asked = [target[0], background[0], write(2000)]
    plain = [plain_model(ts, 200_000 / sum(map(len, ts))) for ts in (target, background)]
    kinds = len(set("".join(target + background))) + 1
    got = {r.doc_id: r for r in lm.score(frame(asked), lm.fit(frame(target), frame(background))).collect()}
    for i, text in enumerate(asked):
        assert abs(got[i].loss_target - plain_loss(plain[0], 200_000, kinds, text)) < 1e-4
        assert abs(got[i].loss_background - plain_loss(plain[1], 200_000, kinds, text)) < 1e-4


def test_blocks_and_merges_do_not_show(spark, monkeypatch):
    texts = ["the cat sat on the mat", None, "", "the dog", "zwölf Boxkämpfer", "the dog"] * 3
    df = spark.createDataFrame(list(zip([1, None, 2, 3, 4, 3] * 3, texts)), "doc_id long, text string").repartition(3, "text")
    whole = sorted(map(str, lm.score(df, lm.fit(df.limit(4), df)).collect()))
    monkeypatch.setattr(lm, "BLOCK_CHARS", 10)
    monkeypatch.setattr(lm, "HELD_GRAMS", 8)
    assert len(whole) == 18 and sorted(map(str, lm.score(df, lm.fit(df.limit(4), df)).collect())) == whole
