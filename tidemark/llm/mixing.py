"""Entropy-balanced mixing of sources to target weights; DataFrame functions only.

Every document gets a rate w in 0 ... 2, how often the mix takes it.  Per source
the rates are those nearest to 1 in relative entropy whose token total is the
source's target: w = min(2, exp(l * x)), x the document's size over the
source's mean size (Hainmueller, Political Analysis 2012, with an upper bound on the
weights).  The multiplier l solves the convex dual by Newton steps that
are distributed: each step sums rates and derivatives over a table of (source, size,
number of documents) and is kept inside a bracket.

Rates become copies by systematic rounding: documents of a source stand in order of
size, and a document gets the whole numbers between the running totals of rates
before and after it, moved by an offset below 1.  A source then differs from
its target by less than its longest document whatever the offset, and copies are
0, 1 or 2; of ``OFFSETS`` offsets each source gets the one that comes nearest.  Running totals come from three levels
(sizes, chunks of documents of equal size, documents of a chunk), so a size that
very many documents have is no single window; rows that agree in everything read here are one
row of a window with their number.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import cut, row_hashes

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (5, 2, 1)
BUDGET = 1.5             # tokens of the mix for each token of the input
MOST = 2                 # times a document is taken
CHUNK_DOCS = 512
TOLERANCE = 1e-6         # of a source's target
OFFSETS = 64             # tried for each source
STEPS = 60               # a bracket halved so often is exact in double precision


def sized(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """(doc_id, source, size): the words of the whole text, 0 for null."""
    words = F.coalesce(F.regexp_count(F.col(text_col), F.lit(WORD)), F.lit(0))
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(source_col).cast("string").alias("source"),
                       words.cast("long").alias("size"))


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, budget: float = BUDGET, most: int = MOST) -> DataFrame:
    """(source, source_size, docs) -> with ``target``: the budget shared by repeating weights over
    the sources by code point (null last), none above ``most`` times its size.

    The shares rise together with one level t, weight * t, until a source is full; sources
    fill in the order of capacity over weight."""
    n = len(weights)
    place = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.pmod(place, F.lit(n)) + 1).cast("int"))
    s = sizes.withColumn("weight", weight).withColumn("room", (most * F.col("source_size")).cast("double"))
    order = Window.orderBy(F.col("room") / F.col("weight"), F.col("source").asc_nulls_last())
    fuller = order.rowsBetween(Window.unboundedPreceding, -1)
    rest = order.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    whole = Window.orderBy(F.lit(0)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    # the level if exactly the sources before this one were full
    level = (budget * F.sum("source_size").over(whole) - F.coalesce(F.sum("room").over(fuller), F.lit(0.0))) \
        / F.sum("weight").over(rest)
    first = F.min(F.when(F.col("level") < F.col("room") / F.col("weight"), F.struct("at", "level"))).over(whole)
    return (s.withColumn("level", level).withColumn("at", F.row_number().over(order)).withColumn("stop", first)
            .withColumn("target", F.when(F.col("stop").isNull() | (F.col("at") < F.col("stop.at")), F.col("room"))
                        .otherwise(F.least("room", F.col("weight") * F.col("stop.level"))))
            .select("source", "source_size", "docs", "target"))


def _rate(most: int):
    return F.least(F.lit(float(most)), F.exp(F.least(F.col("l") * F.col("x"), F.lit(50.0))))


def tilt(histogram: DataFrame, goals: DataFrame, most: int = MOST, tolerance: float = TOLERANCE,
         steps: int = STEPS) -> DataFrame:
    """(source, target, l): the multiplier of every source, by Newton steps inside a bracket.

    ``histogram``: (source, size, n).  A target of ``most`` times the size has no finite
    multiplier and gets null, a target of 0 as well."""
    mean = F.col("source_size") / F.col("docs")
    base = goals.select("source", "target", mean.alias("mean"),
                        ((F.col("target") > 0) & (F.col("target") < most * F.col("source_size"))).alias("open"))
    h = cut(histogram.join(base.filter("open").select(F.col("source").alias("s"), "mean"),
                           F.col("source").eqNullSafe(F.col("s")))
            .filter("size > 0").select("source", "n", (F.col("size") / F.col("mean")).alias("x"), "mean"))
    # l = lo: every rate so small that the total is below any target; l = hi: all rates at the top
    ends = h.groupBy("source").agg(F.min("x").alias("least"), F.sum(F.col("n") * F.col("x")).alias("all"))
    state = (base.filter("open").join(ends.withColumnRenamed("source", "s"), F.col("source").eqNullSafe(F.col("s")))
             .select("source", (F.col("target") / F.col("mean")).alias("goal"), F.lit(0.0).alias("l"),
                     ((F.log(F.col("target") / F.col("mean") / F.col("all")) - 1) / F.col("least")).alias("lo"),
                     ((F.log(F.lit(float(most))) + 1) / F.col("least")).alias("hi"), F.lit(1.0).alias("off")))
    state = cut(state)
    for _ in range(steps):
        met = h.join(state.withColumnRenamed("source", "s"), F.col("source").eqNullSafe(F.col("s")))
        w = _rate(most)
        sums = met.groupBy("source").agg(
            F.sum(F.col("n") * F.col("x") * w).alias("total"),
            F.sum(F.when(w < most, F.col("n") * F.col("x") * F.col("x") * w).otherwise(F.lit(0.0))).alias("slope"),
            F.first("goal").alias("goal"), F.first("l").alias("l"), F.first("lo").alias("lo"), F.first("hi").alias("hi"))
        gap = F.col("total") - F.col("goal")
        lo = F.when(gap < 0, F.col("l")).otherwise(F.col("lo"))
        hi = F.when(gap >= 0, F.col("l")).otherwise(F.col("hi"))
        newton = F.col("l") - gap / F.when(F.col("slope") > 0, F.col("slope"))
        inside = (newton > lo) & (newton < hi)
        off = F.abs(gap) / F.col("goal")
        moved = F.when(off <= tolerance, F.col("l")).when(inside, newton).otherwise((lo + hi) / 2)
        state = cut(sums.select("source", "goal", moved.alias("l"), lo.alias("lo"), hi.alias("hi"), off.alias("off")))
        if (state.agg(F.max("off")).first()[0] or 0.0) <= tolerance:
            break
    return base.join(state.select(F.col("source").alias("s"), "l"), F.col("source").eqNullSafe(F.col("s")), "left") \
        .select("source", "target", "mean", "l")


def _copies(docs: DataFrame, weights: tuple[int, ...], budget: float, most: int, chunk_docs: int) -> DataFrame:
    """``docs``: (doc_id, source, size) and any other columns that tell rows apart -> those with source_size,
    target, ``m``, the number of rows alike, and ``w``, ``from``, of which ``_upto`` makes their copies."""
    histogram = cut(docs.groupBy("source", "size").agg(F.count(F.lit(1)).alias("n")))
    by_source = histogram.groupBy("source").agg(F.sum(F.col("size") * F.col("n")).alias("source_size"),
                                                F.sum("n").alias("docs"))
    goals = cut(targets(by_source, weights, budget, most))
    solved = tilt(histogram, goals, most)
    both = histogram.join(goals.select(F.col("source").alias("s"), "source_size"), F.col("source").eqNullSafe(F.col("s"))) \
        .drop("s").join(solved.withColumnRenamed("source", "s"), F.col("source").eqNullSafe(F.col("s"))).drop("s")
    rate = F.when(F.col("target") <= 0, F.lit(0.0)).when(F.col("l").isNull(), F.lit(float(most))) \
        .otherwise(F.least(F.lit(float(most)), F.exp(F.least(F.col("l") * F.col("size") / F.col("mean"), F.lit(50.0)))))
    before = Window.partitionBy("source").orderBy("size").rowsBetween(Window.unboundedPreceding, -1)
    rated = cut(both.withColumn("w", rate)
                .withColumn("upto", F.coalesce(F.sum(F.col("n") * F.col("w")).over(before), F.lit(0.0)))
                .select(F.col("source").alias("s"), F.col("size").alias("z"), "n", "source_size", "target", "w", "upto",
                        F.ceil(F.col("n") / chunk_docs).alias("chunks")))
    tried = rated.withColumn("k", F.explode(F.sequence(F.lit(0), F.lit(OFFSETS - 1)))) \
        .withColumn("offset", (F.col("k") + 0.5) / OFFSETS)
    whole = F.floor(F.col("upto") + F.col("n") * F.col("w") + F.col("offset")) - F.floor(F.col("upto") + F.col("offset"))
    sums = tried.groupBy("s", "k", "offset").agg(F.sum(F.col("z") * whole).alias("got"), F.first("target").alias("target"))
    nearest = sums.groupBy("s").agg(F.min(F.struct(F.abs(F.col("got") - F.col("target")).alias("off"), "k", "offset")).alias("best")) \
        .select(F.col("s").alias("s2"), F.col("best.offset").alias("offset"))
    rated = cut(rated.drop("n").join(nearest, F.col("s").eqNullSafe(F.col("s2"))).drop("s2"))
    # rows alike are one row with their number, however many have one id or none
    alike = docs.groupBy(*docs.columns).agg(F.count(F.lit(1)).alias("m"))
    ids = [c for c in docs.columns if c not in ("source", "size")]
    named = alike.join(rated, F.col("source").eqNullSafe(F.col("s")) & (F.col("size") == F.col("z"))) \
        .withColumn("chunk", F.pmod(F.xxhash64(*ids), F.col("chunks"))).drop("s", "z", "chunks")
    in_chunk = named.groupBy("source", "size", "chunk").agg(F.sum("m").alias("m"))
    earlier = Window.partitionBy("source", "size").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    starts = in_chunk.withColumn("start", F.coalesce(F.sum("m").over(earlier), F.lit(0))) \
        .select(F.col("source").alias("s"), F.col("size").alias("z"), F.col("chunk").alias("c"), "start")
    placed = named.join(starts, F.col("source").eqNullSafe(F.col("s")) & (F.col("size") == F.col("z"))
                        & (F.col("chunk") == F.col("c"))).drop("s", "z", "c")
    earlier = Window.partitionBy("source", "size", "chunk").orderBy(F.xxhash64(*ids), *ids) \
        .rowsBetween(Window.unboundedPreceding, -1)
    return (placed.withColumn("from", F.col("start") + F.coalesce(F.sum("m").over(earlier), F.lit(0)))
            .withColumn("base", F.col("upto") + F.col("offset")).drop("upto", "offset", "chunk", "start"))


def _between(first, last, most: int):
    """The whole numbers between the running totals of rates behind ``first`` and behind ``last`` rows of a source and size."""
    got = F.floor(F.col("base") + F.col("w") * last) - F.floor(F.col("base") + F.col("w") * first)
    return F.least(most * (last - first), F.greatest(F.lit(0), got))


def _repeated(rows: DataFrame, times: str, number: str) -> DataFrame:
    """Every row as often as ``times`` says, numbered from 1; multiplied in steps of 1,000."""
    steps = F.sequence(F.lit(0).cast("long"), F.call_function("div", F.col(times) - 1, F.lit(1000)))
    each = F.sequence(F.lit(1).cast("long"), F.least(F.lit(1000), F.col(times) - 1000 * F.col("__step")))
    return rows.withColumn("__step", F.explode(steps)).withColumn(number, F.explode(each)) \
        .withColumn(number, F.col(number) + 1000 * F.col("__step")).drop("__step")


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
        weights: tuple[int, ...] = WEIGHTS, budget: float = BUDGET, most: int = MOST,
        chunk_docs: int = CHUNK_DOCS) -> DataFrame:
    """One row per row of ``docs``: (doc_id, size, source_size, target, taken, copies).

    Null texts have size 0 and null sources are one source, the last; documents of size
    0 take nothing whatever their copies; repeated rows are documents of their
    own; an empty table gives no row.  Other columns are not read."""
    found = _repeated(_copies(cut(sized(docs, id_col, text_col, source_col)), weights, budget, most, chunk_docs), "m", "j")
    last = F.col("from") + F.col("j")
    found = found.withColumn("copies", _between(last - 1, last, most).cast("int"))
    return found.select("doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"), "copies")


def mixed_rows(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
               weights: tuple[int, ...] = WEIGHTS, budget: float = BUDGET, most: int = MOST) -> DataFrame:
    """The mix itself: every row of ``docs`` as often as it is taken, all columns as they were.
    Documents of size 0 are taken once, since they cost nothing.

    Rows are told apart by 128 bits of hash over all their columns.  Rows that agree in every
    column are one row here with the sum of their copies, so ids may repeat or be missing."""
    keyed = row_hashes(docs)
    hashes = ["__h1", "__h2"]
    words = F.coalesce(F.regexp_count(F.col(text_col), F.lit(WORD)), F.lit(0)).cast("long")
    measured = keyed.select(F.col(id_col).cast("long").alias("doc_id"), F.col(source_col).cast("string").alias("source"),
                            words.alias("size"), *hashes)
    found = _copies(cut(measured), weights, budget, most, CHUNK_DOCS)
    times = F.when(F.col("size") == 0, F.col("m")).otherwise(_between(F.col("from"), F.col("from") + F.col("m"), most))
    taken = found.select(*hashes, times.cast("long").alias("__times")).filter("__times > 0")
    # equal rows are brought together before they are shuffled, and multiplied in steps of 1,000
    met = keyed.dropDuplicates(hashes).join(taken.hint("merge"), hashes)
    return _repeated(met, "__times", "__each").select(*[F.col(f"`{c}`") for c in docs.columns])
