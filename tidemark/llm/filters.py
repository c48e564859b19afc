"""Filter interaction audit by forward-backward path counting over the subset lattice.

A state of the lattice is the set of filters applied so far, an edge applies one more.  A
document falls on the edges (S, f) where f fails it and no filter of S does, so all that is
needed of the documents is how many fail exactly which filters.  The orders that reach a
state are counted forward, those that leave it backward; the product of the two is the
number of orders over an edge, and a filter's edges weighted by it sum to its Shapley count.
The steps of every order are read from the same edges.
"""

from __future__ import annotations

import json
from itertools import permutations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LETTERS = "ABCDE"
SPACE = " \t\n\x0b\x0c\r"


def paths(k: int) -> tuple[list[int], list[int]]:
    """(orders that reach, orders that leave) each state of the lattice of ``k`` filters."""
    full = (1 << k) - 1
    reach, leave = [1] + [0] * full, [0] * full + [1]
    for s in range(1, full + 1):
        reach[s] = sum(reach[s ^ (1 << i)] for i in range(k) if s >> i & 1)
    for s in range(full - 1, -1, -1):
        leave[s] = sum(leave[s | (1 << i)] for i in range(k) if not s >> i & 1)
    return reach, leave


def edges(k: int) -> list[dict]:
    """Every edge: from state ``s`` by filter ``f``, and the number of orders over it."""
    reach, leave = paths(k)
    return [{"s": s, "f": f, "bit": 1 << f, "orders": reach[s] * leave[s | (1 << f)]}
            for s in range(1 << k) for f in range(k) if not s >> f & 1]


def steps(letters: str) -> list[dict]:
    """Every step of every order, with the place of its edge and of the edges that tell what its
    filter fails in all and alone."""
    k = len(letters)
    at = {(e["s"], e["f"]): i for i, e in enumerate(edges(k))}
    out = []
    for order in permutations(range(k)):
        s = 0
        for step, f in enumerate(order, 1):
            out.append({"filter_order": "".join(letters[i] for i in order), "step": step, "f": f, "edge": at[s, f],
                        "first": at[0, f], "alone": at[((1 << k) - 1) ^ (1 << f), f]})
            s |= 1 << f
    return out


def _constant(rows: list[dict], fields: str) -> Column:
    return F.from_json(F.lit(json.dumps(rows)), f"array<struct<{fields}>>")


def text_failures(text: Column) -> Column:
    """Bits of the filters A to D that a text fails (A: 1, B: 2, C: 4, D: 8)."""
    bare = F.btrim(text, F.lit(SPACE))
    words = F.split(bare, r"[\x20\x09-\x0D]+")
    n = F.when(bare == "", 0).otherwise(F.size(words))
    distinct = F.when(bare == "", 0).otherwise(F.size(F.array_distinct(words)))
    capitals = F.length(F.regexp_replace(text, "[^A-Z]+", "")).cast("long")

    def bit(condition: Column, value: int) -> Column:
        return F.when(condition, value).otherwise(0)
    return (bit(n < 200, 1) + bit(100 * distinct.cast("long") < 50 * n, 2)
            + bit(100 * capitals > 2 * F.length(text), 4) + bit(text.rlike("[#$%&*|]"), 8))


def masks(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(part, mask, n, good, toxic): documents of each source by the very set of filters they fail, and how many
    of them are labelled good and toxic.

    Texts meet by SHA-256.  Rows are summed by (id, text, source) before the labels are
    joined, and by (text, source) before the smallest id of a text is looked up, so a
    common text, source or id is a few sums in any task."""
    text = F.coalesce("text", F.lit(""))
    rows = docs.select("doc_id", F.coalesce(F.col("source").cast("string"), F.lit("")).alias("part"),
                       F.unhex(F.sha2(text, 256)).alias("key"), text_failures(text).alias("mask"))
    by_id = rows.groupBy("doc_id", "part", "key", "mask").agg(F.count(F.lit(1)).alias("n"))
    known = labels.groupBy("doc_id").agg(F.max((F.col("quality") == 1).cast("int")).alias("good"),
                                         F.max((F.col("toxic") == 1).cast("int")).alias("toxic"))
    by_id = by_id.join(known.hint("merge"), "doc_id", "left").select(
        "doc_id", "part", "key", "mask", "n",
        *[(F.coalesce(c, F.lit(0)) * F.col("n")).alias(c) for c in ("good", "toxic")])
    sums = ["n", "good", "toxic"]
    no_id = F.when(F.col("doc_id").isNull(), F.col("n")).otherwise(0)
    by_text = by_id.groupBy("key", "part", "mask").agg(
        *[F.sum(c).alias(c) for c in sums], F.sum(no_id).alias("no_id"),
        F.min(F.when(F.col("doc_id").isNotNull(), F.struct("doc_id", *sums))).alias("first"))
    least = by_text.groupBy("key").agg(F.min("first.doc_id").alias("least"))
    found = by_text.join(least.hint("merge"), "key")
    is_first = F.coalesce(F.col("first.doc_id") == F.col("least"), F.lit(False))
    new = {c: F.when(is_first, F.col(f"first.{c}")).otherwise(0) for c in sums}
    new["n"] = new["n"] + F.col("no_id")
    both = F.array(F.struct("mask", *[new[c].alias(c) for c in sums]),
                   F.struct((F.col("mask") + 16).alias("mask"), *[(F.col(c) - new[c]).alias(c) for c in sums]))
    return (found.select("part", F.inline(both)).groupBy("part", "mask")
            .agg(*[F.sum(c).alias(c) for c in sums]))


def audit(counts: DataFrame, letters: str = LETTERS) -> DataFrame:
    """One row per part, order of the filters and step: (part, filter_order, step, kept, removed, redundant,
    unique_fails, good_lost, toxic_lost, shapley).

    ``counts``: (part, mask, n, good, toxic) as ``masks`` gives them, a mask's bit i standing
    for ``letters[i]``; at most 6 filters (720 orders).  A part without rows has none here
    either; an empty table gives no row.  A part is at most 2^k sums, so everything after
    the grouping by part is done within its row."""
    if not 1 <= len(letters) <= 6:
        raise ValueError("an audit takes one to six filters")
    cells = F.collect_list(F.struct("mask", "n", "good", "toxic"))
    parts = counts.groupBy("part").agg(cells.alias("cells"))
    summed = """transform(edges, e -> named_struct('f', e.f, 'orders', e.orders,
        'kept', aggregate(filter(cells, c -> (c.mask & (e.s | e.bit)) = 0), 0L, (a, c) -> a + c.n),
        'out', aggregate(filter(cells, c -> (c.mask & e.s) = 0 AND (c.mask & e.bit) != 0),
            named_struct('n', 0L, 'good', 0L, 'toxic', 0L),
            (a, c) -> named_struct('n', a.n + c.n, 'good', a.good + c.good, 'toxic', a.toxic + c.toxic))))"""
    shapley = f"""transform(sequence(0, {len(letters) - 1}), i ->
        aggregate(filter(walked, e -> e.f = i), 0L, (a, e) -> a + e.orders * e.out.n))"""
    walked = (parts.withColumn("edges", _constant(edges(len(letters)), "s:int,f:int,bit:int,orders:long"))
              .withColumn("walked", F.expr(summed)).withColumn("shapley", F.expr(shapley)))
    each = walked.select("part", "walked", "shapley", F.explode(_constant(
        steps(letters), "filter_order:string,step:int,f:int,edge:int,first:int,alone:int")).alias("o"))

    def edge(place: str) -> Column:
        return F.col("walked")[F.col(f"o.{place}")]
    removed = edge("edge")["out"]
    return each.select("part", "o.filter_order", "o.step", edge("edge")["kept"].alias("kept"), removed["n"].alias("removed"),
                       (edge("first")["out"]["n"] - removed["n"]).alias("redundant"), edge("alone")["out"]["n"].alias("unique_fails"),
                       removed["good"].alias("good_lost"), removed["toxic"].alias("toxic_lost"),
                       F.col("shapley")[F.col("o.f")].alias("shapley"))
