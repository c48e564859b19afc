"""The field against enumeration, its features against plain counts, held-out accuracy."""

import itertools
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import quality, queries

SF = "/root/testdata/sf0.01"


def some_field(seed=0):
    rnd = np.random.default_rng(seed)
    return quality.Field(np.zeros(quality.WIDTH), np.ones(quality.WIDTH), rnd.normal(size=quality.WIDTH), np.array([0.7, 1.3]))


def test_marginals_match_enumeration():
    field = some_field()
    rnd = np.random.default_rng(1)
    counts = np.array([3, 0, 1, 5, 2])
    u = rnd.normal(size=counts.sum())
    forward, backward, _ = field.messages(u, counts)
    got = 1 / (1 + np.exp(-(forward + backward)))
    at = 0
    for n in counts:
        weights = {y: math.exp(sum(u[at + i] * y[i] for i in range(n))
                               + sum(field.stay[y[i]] for i in range(n - 1) if y[i] == y[i + 1]))
                   for y in itertools.product((0, 1), repeat=int(n))}
        for i in range(n):
            expect = sum(w for y, w in weights.items() if y[i]) / sum(weights.values())
            assert abs(got[at + i] - expect) < 1e-12
        at += n


@pytest.mark.parametrize("group_bytes", [1 << 20, 1, 30])
def test_line_table_matches_plain_counts(monkeypatch, group_bytes):
    monkeypatch.setattr(quality, "GROUP_BYTES", group_bytes)
    texts = ["Hello world world foo\nabc!! x\n\n \t \nthe  long-word long-word other long-word.", None, "", "ééé ÀB 12.", "\n\nq", " ! "]
    x, size, counts = quality.line_table(texts)
    lines = [(i, line) for i, t in enumerate(texts) for line in (t or "").split("\n") if line.strip()]
    assert counts.tolist() == [sum(i == k for i, _ in lines) for k in range(len(texts))]
    for k, (i, line) in enumerate(lines):
        raw = line.encode()
        words = raw.split()
        assert size[k] == len(raw)
        own = x[k, :quality.OWN]
        assert np.isclose(own[1], math.log1p(len(words)) / 6)
        assert np.isclose(own[3], sum(65 <= b <= 90 for b in raw) / max(1, sum(chr(b).isalpha() or b > 127 for b in raw)))
        assert np.isclose(own[9], sum(a == b for a, b in zip(words, words[1:])) / len(words))
        wide = [w for w in words if len(w) > 4]
        assert np.isclose(own[10], (len(wide) - len(set(wide))) / max(1, len(wide)))
        assert own[12] == (raw.rstrip()[-1:] in (b".", b",", b";", b":", b"?", b"'", b'"', b"(", b")", b"-"))
        before = x[k - 1, :quality.OWN] if k and lines[k - 1][0] == i else np.zeros(quality.OWN)
        assert np.array_equal(x[k, quality.OWN:2 * quality.OWN], before)


def test_scores_do_not_depend_on_the_slice():
    field = some_field(3)
    rnd = random.Random(1)
    texts = ["\n".join("w" * rnd.randrange(1, 9) + " !" * rnd.randrange(3) for _ in range(rnd.randrange(0, 20))) for _ in range(40)]
    whole = field.scores(texts)
    assert np.allclose(whole, [field.scores([t])[0] for t in texts])
    assert ((0 <= whole) & (whole <= 1)).all()
    assert field.scores(["", None, " \n "]).tolist() == [0, 0, 0]


def test_held_out_accuracy(spark):
    labels = spark.read.parquet(f"{SF}/labels.parquet").filter("quality IS NOT NULL")
    got = queries.op6_line_quality(spark, SF)
    assert got.count() == 1000
    held = got.join(labels, "doc_id").filter("held_out").select("predicted", "quality").collect()
    assert len(held) > 100 and sum(r.predicted == r.quality for r in held) >= 0.97 * len(held)


def test_labels_that_are_held_out_are_not_read(spark, tmp_path):
    """Turning the held-out labels around changes no score."""
    import shutil
    for name in ("documents", "labels"):
        shutil.copy(f"/root/testdata/sf0.001/{name}.parquet", tmp_path / f"{name}.parquet")
    same = sorted(queries.op6_line_quality(spark, str(tmp_path)).collect())
    labels = spark.read.parquet("/root/testdata/sf0.001/labels.parquet")
    other = tmp_path / "turned"
    labels.withColumn("quality", F.when(queries.held_out(1, 3), 1 - F.col("quality")).otherwise(F.col("quality"))) \
        .write.parquet(str(other / "labels.parquet"))
    shutil.copy("/root/testdata/sf0.001/documents.parquet", other / "documents.parquet")
    assert sorted(queries.op6_line_quality(spark, str(other)).collect()) == same


def test_odd_tables(spark):
    docs = spark.createDataFrame([(1, "good text here.", 0.1), (2, None, 0.1), (3, "", 0.1), (None, "x", None), (1, "good text here.", 0.1)],
                                 "doc_id long, text string, score double")
    labels = spark.createDataFrame([(1, 1), (None, 0), (7, 0), (2, None), (1, 1)], "doc_id long, quality int")
    field = quality.fit(docs, labels)            # only one label has a document
    got = {(r.doc_id, round(r.score, 6)) for r in quality.score(docs, field).collect()}
    assert got == {(1, 1.0), (2, 0.0), (3, 0.0), (None, 1.0)}
    kept = quality.keep(docs, field)
    assert kept.columns == docs.columns and sorted((r.doc_id for r in kept.collect()), key=str) == [1, 1, None]
    none = quality.fit(docs.limit(0), labels.limit(0))
    assert quality.score(docs.limit(0), none).collect() == []
    assert {r.score for r in quality.score(docs.filter("doc_id = 1"), none).collect()} == {1.0}


def test_contradicting_labels_teach_nothing(spark):
    """A document labelled both ways is left out, whatever the order of the rows."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet").limit(150).select("doc_id", "quality")
    some = [r.doc_id for r in labels.limit(20).collect()]
    both = labels.unionByName(labels.filter(labels.doc_id.isin(some)).selectExpr("doc_id", "1 - quality AS quality"))
    a, b = quality.fit(docs, both), quality.fit(docs, labels.filter(~labels.doc_id.isin(some)))
    assert np.array_equal(a.weights, b.weights) and np.array_equal(a.stay, b.stay)
