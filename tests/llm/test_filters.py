"""The audit against applying the filters one after another, in every order."""

import random
import re
from itertools import permutations
from math import factorial

import pytest

from tidemark.llm import filters, queries


def test_paths():
    for k in range(1, 7):
        reach, leave = filters.paths(k)
        assert reach == [factorial(bin(s).count("1")) for s in range(1 << k)]
        assert leave == [factorial(k - bin(s).count("1")) for s in range(1 << k)]
        for f in range(k):      # every order passes exactly one edge of each filter
            assert sum(e["orders"] for e in filters.edges(k) if e["f"] == f) == factorial(k)


def failing(docs):
    """Letters that each row fails."""
    out = []
    for doc, text, _ in docs:
        text = text or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", text)
        out.append({x for x, bad in (
            ("A", len(words) < 200), ("B", 100 * len(set(words)) < 50 * len(words)),
            ("C", 100 * len(re.findall("[A-Z]", text)) > 2 * len(text)), ("D", re.search("[#$%&*|]", text)),
            ("E", doc is not None and any(o is not None and o < doc and (t or "") == text for o, t, _ in docs))) if bad})
    return out


def plain(docs, labels):
    bad, rows = failing(docs), {}
    for part in {s or "" for _, _, s in docs}:
        mine = [(d[0], f) for d, f in zip(docs, bad) if (d[2] or "") == part]
        total = dict.fromkeys("ABCDE", 0)
        for order in permutations("ABCDE"):
            left = mine
            for step, f in enumerate(order, 1):
                gone = [m for m in left if f in m[1]]
                left = [m for m in left if f not in m[1]]
                total[f] += len(gone)
                rows[part, "".join(order), step] = [
                    len(left), len(gone), sum(f in m[1] for m in mine) - len(gone), sum(m[1] == {f} for m in mine),
                    sum((m[0], "good") in labels for m in gone), sum((m[0], "toxic") in labels for m in gone)]
        for (p, order, step), row in rows.items():
            if p == part:
                row.append(total[order[step - 1]])
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_query(spark, tmp_path, seed):
    rnd = random.Random(seed)
    long_text = " ".join(f"word{i}" for i in range(220))
    texts = [None, "", " \n", "few words", "A#B", long_text, long_text + " #", "the " * 250, "the\x0b" * 250 + "$", long_text + " ABCDEFGHIJ" * 20,
             "wide space  x", "É" * 60, "x" * 200_000]
    docs = [(rnd.choice([None, *range(40)]), rnd.choice(texts), rnd.choice([None, "", "web", "books"])) for _ in range(120)]
    labels = [(i, rnd.choice([0, 1, None]), rnd.choice([0, 1, None])) for i in [*range(30), *range(10), None]]
    spark.createDataFrame([(*d, 1) for d in docs], "doc_id long, text string, source string, mask int").write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    told = {(i, "good") for i, q, _ in labels if q == 1 and i is not None} | {(i, "toxic") for i, _, t in labels if t == 1 and i is not None}
    got = {(r.part, r.filter_order, r.step): list(r)[3:] for r in queries.op13_filter_audit(spark, str(tmp_path)).collect()}
    assert got == plain(docs, told) and len(got) == 3 * 600


def test_nothing_and_other_filters(spark):
    none = spark.createDataFrame([], "doc_id long, text string, source string")
    assert filters.audit(filters.masks(none, spark.createDataFrame([], "doc_id long, quality int, toxic int"))).collect() == []
    counts = spark.createDataFrame([("p", 0, 5, 1, 0), ("p", 3, 2, 1, 1), ("p", 1, 4, 0, 0)], "part string, mask int, n long, good long, toxic long")
    got = {(r.filter_order, r.step): tuple(r)[3:] for r in filters.audit(counts, "XY").collect()}
    assert got == {("XY", 1): (5, 6, 0, 4, 1, 1, 10), ("XY", 2): (5, 0, 2, 0, 0, 0, 2),
                   ("YX", 1): (9, 2, 0, 0, 1, 1, 2), ("YX", 2): (5, 4, 2, 4, 0, 0, 10)}
    with pytest.raises(ValueError):
        filters.audit(counts, "ABCDEFG")
