"""Targets, rates and rounding against plain Python."""

import math
import random
import re
from collections import Counter

from tidemark.llm import mixing, queries


def plain_targets(sizes):
    """Shares by weight; what is above twice the size is reshared until none is above."""
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    budget, full = 1.5 * sum(sizes.values()), {}
    while True:
        free = [s for s in names if s not in full]
        share = {s: (budget - sum(full.values())) * weight[s] / sum(weight[f] for f in free) for s in free}
        over = {s: 2.0 * sizes[s] for s in free if share[s] > 2 * sizes[s]}
        if not over:
            return full | share
        full |= over


def made(seed, n=900):
    rnd = random.Random(seed)
    out = []
    for i in range(n):
        source = rnd.choice(["a"] * 6 + ["b", "é", "Z", None, "hot-copies"])
        words = 40 if source == "hot-copies" else int(rnd.lognormvariate(3, 1))
        out.append((i, " ".join(["w"] * words), source))
    return out + [(n, None, "a"), (n + 1, "", None), (n + 2, " \t\n", "b"), (n + 3, "only", "tiny"), (n + 4, None, "empty")]


def test_targets_sizes_and_bounds(spark):
    rows = made(1)
    df = spark.createDataFrame(rows, "doc_id long, text string, source string").selectExpr("*", "1 AS size", "2 AS target", "3 AS l")
    got = {r.doc_id: r for r in mixing.mix(df, chunk_docs=7).collect()}
    assert len(got) == len(rows)
    sizes, taken, largest = Counter(), Counter(), Counter()
    for i, text, source in rows:
        size = len((text or "").split())
        assert got[i].size == size and 0 <= got[i].taken <= 2 * size and got[i].taken == got[i].copies * size
        sizes[source] += size
        taken[source] += got[i].taken
        largest[source] = max(largest[source], size)
    expect = plain_targets(sizes)
    for i, _, source in rows:
        assert got[i].source_size == sizes[source] and math.isclose(got[i].target, expect[source], rel_tol=1e-9, abs_tol=1e-9)
    for source in sizes:
        assert abs(taken[source] - expect[source]) <= max(1, 0.3 * largest[source]), source
    again = {r.doc_id: r for r in mixing.mix(df.repartition(5), chunk_docs=7).collect()}
    assert again == got


def test_rates_are_the_bounded_entropy_balance(spark):
    """min(2, exp(l x)) with the one l per source that meets the target, found here by bisection."""
    sizes = [1, 2, 3, 5, 8, 13, 40, 100]
    histogram = spark.createDataFrame([("s", z, 10) for z in sizes], "source string, size long, n long")
    for part in (0.01, 0.3, 0.9, 1.0, 1.7, 1.999):
        whole = 10 * sum(sizes)
        goals = spark.createDataFrame([("s", whole, 80, part * whole)], "source string, source_size long, docs long, target double")
        r = mixing.tilt(histogram, goals).first()
        mean = whole / 80
        total = lambda k: sum(10 * z * min(2.0, math.exp(min(50, k * z / mean))) for z in sizes)
        lo, hi = -5000.0, 5000.0
        for _ in range(200):
            mid = (lo + hi) / 2
            lo, hi = (mid, hi) if total(mid) < part * whole else (lo, mid)
        assert abs(total(r.l) - part * whole) <= 2e-6 * whole and math.isclose(r.l, lo, rel_tol=1e-3, abs_tol=1e-4), part


def test_given_documents(spark):
    got = queries.op9_mixing(spark, "/root/testdata/sf0.01").collect()
    assert len(got) == 1000 and got[0].asDict().keys() == {"doc_id", "size", "source_size", "target", "taken"}
    docs = {r.doc_id: r for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").collect()}
    taken, target = Counter(), {}
    for r in got:
        assert r.size == len(re.findall(r"[^\x20\x09-\x0D]+", docs[r.doc_id].text))
        taken[docs[r.doc_id].source] += r.taken
        target[docs[r.doc_id].source] = r.target
    assert all(abs(taken[s] / target[s] - 1) < 0.05 for s in target)


def test_mixed_rows(spark):
    rows = [(1, "a b c", "s", 5), (2, None, "s", None), (3, "d e", None, 6), (3, "d e", None, 6), (None, "x y z", "s", 7)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, __copies int")
    out = mixing.mixed_rows(df.withColumnRenamed("__copies", "copies"))
    assert out.columns == ["doc_id", "text", "source", "copies"]
    counts = Counter(tuple(r) for r in out.collect())
    assert set(counts) <= set(rows) and counts[2, None, "s", None] == 1
    assert all(n <= 2 * rows.count(r) for r, n in counts.items())
    assert mixing.mix(df.limit(0)).collect() == [] and mixing.mixed_rows(df.limit(0)).collect() == []


def test_no_python_in_the_plan(spark):
    plan = queries.op9_mixing(spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert not any(word in plan for word in ("Python", "Pandas", "Arrow"))


def test_mixed_rows_without_ids_take_what_the_mix_takes(spark):
    """Rows that agree in id, source and size, with other texts or the very same one."""
    rows = [(None, f"w{i % 40} b c d e f g h i", "a") for i in range(100)] + [(7, "x y z", "b")] * 30 + [(None, None, "a")] * 3
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    want = {r.source: r.taken for r in mixing.mix(df).withColumn("source", mixing.F.when(mixing.F.col("size") == 3, "b").otherwise("a"))
            .groupBy("source").agg(mixing.F.sum("taken").alias("taken")).collect()}
    got, times = {"a": 0, "b": 0}, {}
    for r in mixing.mixed_rows(df).collect():
        got[r.source] += len((r.text or "").split())
        times[r.text] = times.get(r.text, 0) + 1
    assert got == want and times[None] == 3
    assert all(n <= 2 * sum(t == text for _, t, _ in rows) for text, n in times.items())


def test_rows_alike_are_one_row_of_a_window(spark):
    """Many rows of one id, and of none, of one size: each gets its copies, the total meets the target."""
    rows = [(None, "a b c", "s")] * 2500 + [(5, "d e f", "s")] * 1200 + [(i, "g h i", "s") for i in range(10, 40)] + [(1, "x y", "t")] * 9
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    found = mixing.mix(df, chunk_docs=8)
    got = found.collect()
    assert Counter(r.doc_id for r in got) == Counter(i for i, _, _ in rows)
    assert all(0 <= r.copies <= 2 and r.taken == r.copies * r.size for r in got)
    s = [r for r in got if r.size == 3]
    assert abs(sum(r.taken for r in s) - s[0].target) <= 3
    assert sorted(map(str, mixing.mix(df.repartition(3), chunk_docs=8).collect())) == sorted(map(str, got))
    assert sum(len(r.text.split()) for r in mixing.mixed_rows(df).filter("source = 's'").collect()) == \
        sum(r.taken for r in mixing.mix(df).collect() if r.size == 3)
