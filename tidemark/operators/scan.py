"""Ordered per-key scans (running sum / min / max / nearest row) without hot groups.

A Spark window function sorts a whole ``partitionBy`` group inside one task.
That is the right plan for keys of ordinary size.  When one key holds a large share of all
rows (one user, one order id, or no key at all) that task would be the whole job, so such
a key is cut in chunks along the scan order.  Which keys these are is part of the query
(``heavy_keys``): nothing runs while a query is built.  Only an input that Spark's own
statistics put at so few bytes that one task can sort all of it is scanned by a plain window.

1. rows are shuffled once, by ``(key, chunk)``;
2. within each ``(key, chunk)``: the window aggregate over the rows before (or
   up to) the current one;
3. the running value at the last row of every chunk of a cut key, from the same
   shuffled rows (the exchange is reused);
4. per cut key over these chunk rows only: the aggregate of all *earlier* chunks;
5. that prefix is joined back on ``(key, chunk)`` and combined.

All steps are plain DataFrame operations.  ``chunk`` must be non-decreasing in the
scan order.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.time import floor_div


@dataclass(frozen=True)
class ScanAgg:
    """One running aggregate.

    kind: ``sum`` | ``min`` | ``max`` | ``nearest`` | ``next`` | ``prev``.
    ``nearest`` is the value of ``expr`` at the closest row before the current
    one in scan direction where it is not null (a null-skipping ``lag``);
    ``next`` / ``prev`` are exactly ``lead`` / ``lag`` by one row in scan
    direction (they ignore ``inclusive``).
    """

    name: str
    kind: str
    expr: Column


# Rows that one task may sort for one key; keys with more are cut in chunks of about so
# many.  The session setting tunes it at scale without code changes.
CHUNK_ROWS = 1_000_000
CHUNK_CONF = "tidemark.scan.chunkRows"
# An input of at most so many bytes by Spark's statistics (of files: their size) is not cut: one
# task can sort it whole, whatever its keys.
SMALL_BYTES = 64 << 20
# A scan without a key is dealt over the cores in chunks of so many rows at least.
LEAST_ROWS = 1_000
# Keys that a frequent-items sketch tracks.  A sketch errs by at most 3.5 / TRACKED of its rows and
# names every key above twice that, so a key is found if it has over CHUNK_ROWS rows
# and over 1 / 9,362 of all rows.
TRACKED = 1 << 16
# Sketches are merged in so many groups of tasks first, then these.
MERGED = 256


@dataclass(frozen=True)
class Chunks:
    """How the rows of a scan are cut: in chunks of about ``rows`` rows along a bigint column,
    ``always`` also where the input is small."""

    along: str
    rows: int
    always: bool = True


def is_small(df: DataFrame) -> bool:
    """Whether Spark's statistics bound the input by ``SMALL_BYTES``; no job is run."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())) <= SMALL_BYTES


def heavy_keys(df: DataFrame, keys: list[str], along: str, rows: int) -> DataFrame:
    """(hash of the key, chunk width) of every key with over ``rows`` rows, as part of the query.

    Each task makes a frequent-items sketch of its keys' hashes, sketches are merged in two
    steps, and no row is shuffled by its key.  The keys so named are then counted exactly,
    with the span of ``along`` that they cover: a filter against the broadcast names
    (of 8 bytes; over 7 / TRACKED of all rows each, so at most TRACKED / 7) and partial sums.  Two keys of one hash count as one
    and are cut together, which changes no result."""
    named = df.select(F.xxhash64(*keys).alias("__h"), F.col(along).alias("__along"))
    sketches = (named.select("__h", (F.spark_partition_id() % MERGED).alias("__g")).groupBy("__g")
                .agg(F.expr(f"approx_top_k_accumulate(__h, {TRACKED})").alias("__s")))
    # (grouped by a constant, an empty input has no group and so no sketch)
    top = sketches.groupBy(F.lit("all")).agg(F.expr("approx_top_k_combine(__s)").alias("__s")) \
        .select(F.explode(F.expr(f"approx_top_k_estimate(__s, {TRACKED // 7})")).alias("__t"))
    names = top.filter(F.col("__t.count") > rows).select(F.col("__t.item").alias("__name"))
    counted = (named.join(F.broadcast(names), F.col("__h") == F.col("__name"), "left_semi").groupBy("__h")
               .agg(F.count(F.lit(1)).alias("__n"), F.min("__along").alias("__lo"), F.max("__along").alias("__hi")))
    return counted.filter(F.col("__n") > rows).select("__h", _width("__n", "__lo", "__hi", F.lit(rows)).alias("__width"))


def _width(n: str, low: str, high: str, rows: Column) -> Column:
    span = (F.col(high) - F.col(low) + 1).cast("decimal(38,0)")
    return F.greatest(F.lit(1), F.ceil(span * rows / F.col(n))).cast("bigint")


def _whole_width(df: DataFrame, along: str, rows: int) -> Column:
    """Chunk width of a scan without a key, from one row of totals (a scalar subquery)."""
    spread = max(1, df.sparkSession.sparkContext.defaultParallelism)
    each = F.least(F.lit(rows), F.greatest(F.lit(LEAST_ROWS), F.ceil(F.col("n") / spread)))
    totals = df.agg(F.count(F.lit(1)).alias("n"), F.min(along).alias("lo"), F.max(along).alias("hi"))
    return F.coalesce(totals.select(_width("n", "lo", "hi", each)).scalar(), F.lit(1).cast("bigint"))


def time_chunk(ts_us: Column, width_us: int) -> Column:
    """Chunk id of a fixed width from an epoch-microsecond column."""
    return floor_div(ts_us, width_us)


def chunks_for(df: DataFrame, along: str, chunk_us: int | None = None,
               chunk_rows: int | None = None) -> Chunks | Column:
    """Fixed chunks if a width is given, else chunks of ``chunk_rows`` rows.  By default they have the
    session's number of rows, or a million if the input is not small."""
    if chunk_us:
        return time_chunk(F.col(along), chunk_us)
    rows = chunk_rows or df.sparkSession.conf.get(CHUNK_CONF, None)
    return Chunks(along, int(rows or CHUNK_ROWS), rows is not None)


_RUNNING = {
    "sum": F.sum,
    "min": F.min,
    "max": F.max,
    "nearest": lambda c: F.last(c, ignorenulls=True),
}


def _over(a: ScanAgg, value: Column, by_row, frame) -> Column:
    if a.kind == "next":
        return F.lead(value).over(by_row)
    if a.kind == "prev":
        return F.lag(value).over(by_row)
    return _RUNNING[a.kind](value).over(frame)


def segmented_scan(df: DataFrame, keys: list[str], order: list[str], aggs: list[ScanAgg],
                   chunk: Chunks | Column | None = None, reverse: bool = False, inclusive: bool = False,
                   _nested: bool = False) -> DataFrame:
    """Add one column per ``ScanAgg`` holding its running value.

    keys: partition columns of the scan (may be empty: one global order).
    order: columns giving a total order within a key (e.g. ``ts_us, event_id``).
    chunk: chunks of a number of rows for keys with more, a chunk column, or None (no key is cut).
    reverse: scan from the last row backwards (``nearest`` then means *next*).
    inclusive: whether the current row is part of its own frame.

    The rows are read and shuffled once; with ``Chunks``, the keys and ``along`` are read for
    the heavy keys besides.  All columns of ``df`` are shuffled: project before scanning.
    """
    if not aggs:
        return df
    direction = (lambda c: F.col(c).desc()) if reverse else (lambda c: F.col(c).asc())
    upper = Window.currentRow if inclusive else -1
    sort = [direction(c) for c in order]
    if chunk is None or isinstance(chunk, Chunks) and not chunk.always and is_small(df):
        by_row = Window.partitionBy(*keys).orderBy(*sort)
        frame = by_row.rowsBetween(Window.unboundedPreceding, upper)
        out = df
        for a in aggs:
            value = _over(a, a.expr, by_row, frame)
            out = out.withColumn(a.name, F.coalesce(value, F.lit(0)) if a.kind == "sum" else value)
        return out

    ck, cut = "__scan_chunk", "__scan_cut"
    if isinstance(chunk, Column):
        base = df.withColumn(ck, chunk).withColumn(cut, F.lit(True))
    elif not keys:
        along = F.col(chunk.along)
        width = _whole_width(df, chunk.along, chunk.rows)
        base = (df.withColumn("__width", width)
                .withColumn(ck, F.call_function("div", along - F.pmod(along, "__width"), F.col("__width")))
                .withColumn(cut, F.lit(True)).drop("__width"))
    else:
        heavy = heavy_keys(df, keys, chunk.along, chunk.rows)
        along = F.col(chunk.along)
        base = (df.join(F.broadcast(heavy), F.xxhash64(*keys) == F.col("__h"), "left")
                .withColumn(cut, F.col("__width").isNotNull())
                .withColumn(ck, F.when(F.col(cut), F.call_function(
                    "div", along - F.pmod(along, "__width"), F.col("__width"))).otherwise(F.lit(0).cast("bigint")))
                .drop("__width", "__h"))
    # Non-null stand-ins for the keys (value with nulls replaced, plus an
    # is-null flag): grouping on them equals grouping on the keys, and the
    # join back below can be a plain equi-join on the very columns the
    # rows were shuffled by, so they are not shuffled again.
    norm: list[str] = []
    for i, k in enumerate(keys):
        kind = base.schema[k].dataType.simpleString()
        stand_in = {"string": F.lit(""), "date": F.lit("1970-01-01").cast("date"), "boolean": F.lit(False),
                    "timestamp": F.timestamp_micros(F.lit(0).cast("bigint")),
                    "timestamp_ntz": F.lit("1970-01-01").cast("timestamp_ntz")}.get(kind)
        stand_in = F.lit(0).cast(kind) if stand_in is None else stand_in
        base = (base.withColumn(f"__sk{i}v", F.coalesce(F.col(k), stand_in))
                .withColumn(f"__sk{i}n", F.col(k).isNull()))
        norm += [f"__sk{i}v", f"__sk{i}n"]
    part = [*norm, ck]
    names = [f"__a{i}" for i in range(len(aggs))]
    rows = base.withColumns({n: a.expr for n, a in zip(names, aggs)}).repartition(*part)
    by_row = Window.partitionBy(*part).orderBy(*sort)
    frame = by_row.rowsBetween(Window.unboundedPreceding, upper)
    whole = by_row.rowsBetween(Window.unboundedPreceding, Window.currentRow)

    within = rows.withColumns(
        {f"__in_{n}": _over(a, F.col(n), by_row, frame) for n, a in zip(names, aggs)}
        # at the chunk's edge the neighbour comes from the adjacent chunk
        | {"__first": F.lag(F.lit(1)).over(by_row).isNull(), "__last": F.lead(F.lit(1)).over(by_row).isNull()})

    # The condition on the hash is true for every row.  It reads all columns, so that both
    # uses of the shuffled rows need the same columns, whatever a caller drops
    # later, and share one exchange.
    carried = [c for c in base.columns if c not in part and base.schema[c].dataType.typeName() != "map"]
    every = F.hash(*carried) >= -2**31

    # what a chunk hands on: its running value at its last row, for ``next`` the value at
    # its first row
    # (only rows of cut keys; the condition is not pushed below the shuffle, which both uses share)
    of_cut = F.rand(0) + F.col(cut).cast("double") >= 1      # rand() is below 1: just ``cut``
    taken = rows.filter(of_cut).withColumns({f"__ch_{n}": F.col(n) if a.kind in ("next", "prev") else _over(a, F.col(n), by_row, whole)
                              for n, a in zip(names, aggs)}
                             | {"__first": F.lag(F.lit(1)).over(by_row).isNull(),
                                "__last": F.lead(F.lit(1)).over(by_row).isNull()}) \
        .filter(every)
    sides = {"__first" if a.kind == "next" else "__last" for a in aggs}
    if len(sides) == 1:
        ends = taken.filter(sides.pop())
    else:   # one row per chunk from its two edge rows
        ends = taken.filter("__first OR __last").groupBy(*part).agg(*[
            F.max_by(f"__ch_{n}", F.when(F.col("__first"), F.lit(1)).otherwise(F.lit(0))).alias(f"__ch_{n}")
            if a.kind == "next" else
            F.max_by(f"__ch_{n}", F.when(F.col("__last"), F.lit(1)).otherwise(F.lit(0))).alias(f"__ch_{n}")
            for n, a in zip(names, aggs)])
    summary = ends.select(*part, *[f"__ch_{n}" for n in names])

    renamed = {c: f"__pk{i}" for i, c in enumerate(part)}
    if not keys and not _nested:
        # No key: the chunk rows form one global order too.  Their prefix is itself a
        # segmented scan (groups of 1,024 chunks), so no task holds every chunk
        # row -- only the few group rows meet in one window.
        inner = segmented_scan(
            summary.withColumnRenamed(ck, "__outer_chunk"), [], ["__outer_chunk"],
            [ScanAgg(f"__out_{n}", a.kind, F.col(f"__ch_{n}")) for n, a in zip(names, aggs)],
            floor_div(F.col("__outer_chunk"), 1024), reverse=reverse, inclusive=False, _nested=True)
        prefix = inner.select(F.col("__outer_chunk").alias(renamed[ck]), *[F.col(f"__out_{n}").alias(f"__pre_{n}") for n in names])
    else:
        by_chunk = Window.partitionBy(*norm).orderBy(direction(ck))
        before = by_chunk.rowsBetween(Window.unboundedPreceding, -1)
        prefix = summary.select(
            *[F.col(c).alias(renamed[c]) for c in part],
            *[_over(a, F.col(f"__ch_{n}"), by_chunk, before).alias(f"__pre_{n}") for n, a in zip(names, aggs)])

    cond = reduce(lambda x, y: x & y, [F.col(c) == F.col(renamed[c]) for c in part])
    out = within.filter(every).join(prefix, cond, "left").drop(*renamed.values())
    for n, a in zip(names, aggs):
        cur, pre = F.col(f"__in_{n}"), F.col(f"__pre_{n}")
        if a.kind == "sum":
            val = F.coalesce(cur, F.lit(0)) + F.coalesce(pre, F.lit(0))
        elif a.kind == "min":
            val = F.least(cur, pre)
        elif a.kind == "max":
            val = F.greatest(cur, pre)
        elif a.kind in ("next", "prev"):
            val = F.when(F.col("__last" if a.kind == "next" else "__first"), pre).otherwise(cur)
        else:
            val = F.coalesce(cur, pre)
        out = out.withColumn(a.name, val)
    return out.drop(ck, cut, "__first", "__last", *norm, *names, *[f"__in_{n}" for n in names],
                    *[f"__pre_{n}" for n in names])
