"""Fingerprints and groups against brute force; defined results for odd rows."""

import random
import re

import numpy as np
import pytest
import xxhash

from tidemark.llm import simhash


def plain_fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    grams = [" ".join(words[i:i + 3]) for i in range(len(words) - 2)] if len(words) >= 3 else [" ".join(words)] * bool(words)
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(docs, radius=3):
    """doc_id -> smallest id reachable over links of at most ``radius`` bits."""
    fp = {i: plain_fingerprint(t) for i, t in docs}
    least = {i: i for i in fp}
    changed = True
    while changed:
        changed = False
        for a in fp:
            for b in fp:
                if (fp[a] ^ fp[b]).bit_count() <= radius and least[b] < least[a]:
                    least[a], changed = least[b], True
    return fp, least


def found(df):
    return {r.doc_id: (r.fingerprint, r.component_id) for r in df.collect()}


@pytest.mark.parametrize("list_bytes", [1 << 20, 1, 7])
def test_fingerprint_cases(monkeypatch, list_bytes):
    monkeypatch.setattr(simhash, "LIST_BYTES", list_bytes)
    texts = ["", None, " \n\t", "one", "Two words", "THREE word text", "É é É é",
             "a b c a b c a b c", "x y z w v u", "x " * 70_000]
    for t in texts:
        assert simhash.fingerprint(t) == plain_fingerprint(t)
    assert simhash.fingerprint("") == 0
    assert simhash.fingerprint("ABC d e") == simhash.fingerprint("abc d e") != simhash.fingerprint("É d e")


@pytest.mark.parametrize("tile_rows", [4096, 3])
def test_groups_match_brute_force(spark, tile_rows):
    rnd = random.Random(3)
    words = ["w%d" % i for i in range(200)]
    docs = []
    for i in range(60):
        text = [rnd.choice(words) for _ in range(150)]
        docs.append(" ".join(text))
        for _ in range(rnd.choice([0, 0, 1, 4])):   # near copies: a word or two changed
            text = list(text)
            text[rnd.randrange(150)] = rnd.choice(words)
            docs.append(" ".join(text))
    docs += [docs[0]] * 5 + ["", None, " "]
    rnd.shuffle(docs)
    rows = list(enumerate(docs, 100))
    fp, least = plain_components(rows)
    got = found(simhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), tile_rows=tile_rows))
    assert got == {i: ("%016x" % fp[i], least[i]) for i in fp}
    assert len(set(least.values())) < len(least)


def test_forest_connects_what_links_connect():
    rnd = np.random.default_rng(1)
    base = rnd.integers(0, 2**63, 20, dtype=np.uint64)
    near = (base[:, None] ^ (np.uint64(1) << np.arange(64, dtype=np.uint64))[None]).ravel()
    both = np.unique(np.concatenate([base, near]))
    u, v = simhash.forest(both, both, 3)
    assert len(u) == len(both) - len(base)   # one tree for each base value, whatever the number of links
    assert all(int(a ^ b).bit_count() <= 6 for a, b in zip(u, v))


def test_odd_rows_and_columns(spark):
    schema = "fp string, doc_id long, text string, component_id string, slot int"
    rows = [("x", 5, "same text here and there", "y", 1), ("x", 5, "same text here and there", "y", 1),
            ("x", 3, "Same Text here and there", "y", 1), ("x", None, "same text here and there", None, None),
            ("x", 9, None, None, None), ("x", 8, "", None, None), (None, None, None, None, None)]
    df = spark.createDataFrame(rows, schema)
    got = sorted(((r.doc_id, r.component_id) for r in simhash.near_duplicates(df).collect()), key=str)
    assert got == sorted([(5, 3), (5, 3), (3, 3), (None, 3), (9, 8), (8, 8), (None, 8)], key=str)
    kept = simhash.one_per_group(df)
    assert kept.columns == df.columns
    assert sorted((r.doc_id for r in kept.collect()), key=str) == [3, 8]
    empty = spark.createDataFrame([], schema)
    assert simhash.near_duplicates(empty).collect() == [] and simhash.one_per_group(empty).collect() == []


def test_one_row_of_a_repeated_document_is_kept(spark):
    df = spark.createDataFrame([(1, "a b c"), (1, "a b c"), (2, "q r s t u v w")], "doc_id long, text string")
    assert sorted(r.doc_id for r in simhash.one_per_group(df).collect()) == [1, 2]


def test_components_of_a_long_chain_and_a_star(spark):
    from tidemark.llm.components import components
    chain = [(i, i + 1) for i in range(0, 40)]
    star = [(100, 100 + i) for i in range(1, 200)] + [(150, 150), (101, 100)]
    df = spark.createDataFrame(chain + star, "u long, v long")
    got = {r.node: r.root for r in components(df).collect()}
    assert got == {**{i: 0 for i in range(41)}, **{100 + i: 100 for i in range(200)}}


def test_every_group_keeps_one_row(spark):
    """Ids repeated with unrelated texts or missing: one row of each group, the same on a rerun."""
    one, two, three = ("one text of some words that is long enough to be itself", "quite another text with other words in it",
                       "a third text of which nobody has an id but several have a copy")
    rows = [(5, one, "a"), (5, two, "a"), (7, two, "b"), (3, one, "b"), (None, three, "a"), (None, three, "a"), (None, three, "b"),
            (None, one, "c"), (3, one, "b"), (9, None, "a"), (None, "", "a")]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    kept = sorted(map(tuple, simhash.one_per_group(df).collect()), key=str)
    assert {(r[0], r[1] or "") for r in kept} == {(3, one), (5, two), (None, three), (9, "")} and len(kept) == 4
    assert kept == sorted(map(tuple, simhash.one_per_group(df.repartition(5)).collect()), key=str)
