"""Stream sinks: labelled console/memory/file output, keyed upserts, reports."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidemark.session import streaming_checkpoint


def start_sink(df: DataFrame, name: str, fmt: str = "console", output_mode: str = "append",
               path: str | None = None, checkpoint: str | None = None,
               trigger: dict | None = None) -> StreamingQuery:
    """Start ``df`` into a console / memory / parquet sink under ``name``.

    The checkpoint goes under the cluster's shared ``spark.checkpoint.dir``
    unless given, so a restarted driver resumes exactly once.
    """
    w = df.writeStream.queryName(name).outputMode(output_mode).format(fmt)
    w = w.option("checkpointLocation", checkpoint or streaming_checkpoint(df.sparkSession, name))
    if fmt not in ("console", "memory", "noop"):
        if not path:
            raise ValueError("file sinks need a path")
        w = w.option("path", path)
    if trigger:
        w = w.trigger(**trigger)
    return w.start()


class Marks:
    """One number per micro-batch, kept in a folder: what the batches up to it have seen.
    A replayed batch finds the mark of the batch before it, not its own."""

    def __init__(self, path: str) -> None:
        self.path = path

    def before(self, spark: SparkSession, batch_id: int) -> int | None:
        if batch_id == 0:
            return None
        return spark.read.schema("mark bigint").json(f"{self.path}/batch_{batch_id - 1}").first().mark

    def put(self, spark: SparkSession, batch_id: int, mark: int | None) -> None:
        one = spark.range(1).select(F.lit(mark).cast("bigint").alias("mark"))
        one.write.mode("overwrite").option("ignoreNullFields", "false").json(f"{self.path}/batch_{batch_id}")


def _delete(spark: SparkSession, path: str) -> None:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def _folders(spark: SparkSession, path: str, prefix: str) -> list[int]:
    """The numbers n of the complete folders ``<prefix><n>`` under ``path``, ascending."""
    root = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = root.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(root):
        return []
    found = []
    for status in fs.listStatus(root):
        name = status.getPath().getName()
        done = spark._jvm.org.apache.hadoop.fs.Path(status.getPath(), "_SUCCESS")
        if name.startswith(prefix) and name[len(prefix):].lstrip("-").isdigit() and fs.exists(done):
            found.append(int(name[len(prefix):]))
    return sorted(found)


def upsert_sink(df: DataFrame, path: str, key_cols: list[str], name: str,
                checkpoint: str | None = None, output_mode: str = "update",
                compact_every: int = 100, trigger: dict | None = None) -> StreamingQuery:
    """Keyed upsert of a windowed result (e.g. the count per window end).

    Each micro-batch is written under ``batch_<n>``; ``read_upserted`` keeps the
    newest row per key.  Replayed batches overwrite their own folder, so a retry
    does not duplicate rows.  Every ``compact_every`` batches the newest rows are
    folded into one ``snapshot_<n>`` and the folders it replaces are removed, so
    neither files nor reads grow with the number of batches.
    """
    folder = path.rstrip("/")

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{folder}/batch_{batch_id}")
        if (batch_id + 1) % compact_every == 0:
            compact_upserted(batch.sparkSession, folder, key_cols, batch_id)

    return foreach_batch(df, write, name, output_mode, checkpoint, trigger)


def compact_upserted(spark: SparkSession, path: str, key_cols: list[str], upto: int) -> None:
    """Fold the snapshot and the batches up to ``upto`` into ``snapshot_<upto>``.  The old folders
    go only after the new one is complete; a run that broke off is simply repeated."""
    folder = path.rstrip("/")
    read_upserted(spark, folder, key_cols, upto).write.mode("overwrite").parquet(f"{folder}/snapshot_{upto}")
    for n in _folders(spark, folder, "batch_"):
        if n <= upto:
            _delete(spark, f"{folder}/batch_{n}")
    for n in _folders(spark, folder, "snapshot_"):
        if n < upto:
            _delete(spark, f"{folder}/snapshot_{n}")


def read_upserted(spark: SparkSession, path: str, key_cols: list[str], upto: int | None = None) -> DataFrame:
    """Latest row per key from an ``upsert_sink`` folder (of the batches up to ``upto``)."""
    folder = path.rstrip("/")
    snapshots = [n for n in _folders(spark, folder, "snapshot_") if upto is None or n < upto]
    base = snapshots[-1] if snapshots else -1
    batches = [n for n in _folders(spark, folder, "batch_") if n > base and (upto is None or n <= upto)]
    names = [f"{folder}/snapshot_{base}"] * bool(snapshots) + [f"{folder}/batch_{n}" for n in batches]
    if not names:
        raise FileNotFoundError(f"no complete batch in {folder}")
    number = F.regexp_extract(F.col("_metadata.file_path"), r"/(?:batch|snapshot)_(\d+)/[^/]*$", 1).cast("bigint")
    df = spark.read.parquet(*names).withColumn("__n", number)
    newest = Window.partitionBy(*key_cols).orderBy(F.col("__n").desc())
    return df.withColumn("__r", F.row_number().over(newest)).filter("__r = 1").drop("__r", "__n")


def foreach_batch(df: DataFrame, fn: Callable[[DataFrame, int], None], name: str,
                  output_mode: str = "append", checkpoint: str | None = None,
                  trigger: dict | None = None) -> StreamingQuery:
    """Run a batch operator on every micro-batch (e.g. re-rank changed windows)."""
    w = (df.writeStream.queryName(name).outputMode(output_mode).foreachBatch(fn)
         .option("checkpointLocation", checkpoint or streaming_checkpoint(df.sparkSession, name)))
    return (w.trigger(**trigger) if trigger else w).start()


def dead_letter_sink(lines: DataFrame, parse: Callable[[DataFrame], DataFrame], out_path: str, rejects_path: str,
                     name: str, checkpoint: str | None = None, trigger: dict | None = None) -> StreamingQuery:
    """Good rows and dead letters of a stream of ``sources.text.raw_lines`` in one pass per micro-batch.

    ``parse`` takes numbered lines and parses them with ``on_bad="tag", carry=RAW``.  Both tables are
    written by batch with overwrite, so a replayed batch replaces its rows."""
    from tidemark.sources.text import numbered_lines, split_rejects

    def write(batch: DataFrame, batch_id: int) -> None:
        tagged = parse(numbered_lines(batch)).persist()
        try:
            for part, path in zip(split_rejects(tagged), (out_path, rejects_path)):
                part.write.mode("overwrite").parquet(f"{path.rstrip('/')}/batch_id={batch_id}")
        finally:
            tagged.unpersist()

    return foreach_batch(lines, write, name, "append", checkpoint, trigger)


def top_n_each_batch(counts: DataFrame, key_col: str, n: int, path: str, name: str,
                     count_col: str = "cnt", checkpoint: str | None = None,
                     trigger: dict | None = None) -> StreamingQuery:
    """Rank an append-mode windowed-count stream per micro-batch and append
    the top ``n`` of each window to parquet at ``path``.

    In append mode a window's final counts for all keys arrive in the same
    micro-batch (the one whose watermark passes its end), so ranking each batch
    with the batch ``top_n`` is exact -- and keeps no per-window list of keys in
    state, unlike the chained ``stream_top_n``; for windows with very many keys.
    Batches are written under ``batch_id=<n>`` with overwrite, so a replayed
    batch replaces its own output.
    """
    from tidemark.operators.topn import top_n

    def write(batch: DataFrame, batch_id: int) -> None:
        ranked = top_n(batch.drop("window") if "window" in batch.columns else batch,
                       "window_end_ms", key_col, n, count_col)
        ranked.write.mode("overwrite").parquet(f"{path.rstrip('/')}/batch_id={batch_id}")

    return foreach_batch(counts, write, name, "append", checkpoint, trigger)


def rerank_each_batch(counts: DataFrame, key_col: str, n: int, counts_path: str, out_path: str,
                      name: str, count_col: str = "cnt", checkpoint: str | None = None,
                      trigger: dict | None = None) -> StreamingQuery:
    """Top-N per window that is corrected when late rows change a window.

    ``counts`` is an update-mode windowed count stream (e.g.
    ``stream_sliding_count(..., method="native")`` with the lateness in its
    delay): every micro-batch carries the new counts of the (window, key)
    pairs it changed.  Each batch is written to ``counts_path`` (parquet, by batch and
    window end), the windows it changed are read back -- a range of window ends as a
    literal partition filter, so no other partition is scanned -- and their newest
    counts are ranked into ``out_path`` with ``version`` = batch id.  The newest
    version of a window is its current ranking.  A replayed batch replaces its own
    folders and reads no later ones, so its rows are the same again.
    """
    from tidemark.operators.topn import top_n

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        changed = (batch.drop("window") if "window" in batch.columns else batch).persist()
        try:
            (changed.repartition("window_end_ms").write.mode("overwrite").partitionBy("window_end_ms")
             .parquet(f"{counts_path.rstrip('/')}/batch_id={batch_id}"))
            span = changed.agg(F.min("window_end_ms"), F.max("window_end_ms")).first()
            if span[0] is None:
                return
            hist = (spark.read.option("basePath", counts_path).parquet(counts_path)
                    .filter(F.col("window_end_ms").between(span[0], span[1]) & (F.col("batch_id") <= batch_id))
                    .join(changed.select("window_end_ms").distinct(), "window_end_ms", "left_semi"))
            newest = Window.partitionBy("window_end_ms", key_col).orderBy(F.col("batch_id").desc())
            latest = (hist.withColumn("__r", F.row_number().over(newest)).filter("__r = 1")
                      .drop("__r", "batch_id"))
            (top_n(latest, "window_end_ms", key_col, n, count_col)
             .withColumn("version", F.lit(batch_id).cast("bigint"))
             .write.mode("overwrite").parquet(f"{out_path.rstrip('/')}/batch_id={batch_id}"))
        finally:
            changed.unpersist()

    return foreach_batch(counts, write, name, "update", checkpoint, trigger)


def sliding_counts_each_batch(df: DataFrame, keys: list[str], size_s: float, slide_s: float, panes_path: str,
                              out_path: str, name: str, ts: str = "ts", delay_s: float = 0, count_col: str = "cnt",
                              checkpoint: str | None = None, trigger: dict | None = None) -> StreamingQuery:
    """Long sliding windows on a stream (1 day every 5 s): rows per key and window, each window
    once, when the watermark has passed its end.

    The stream itself only counts rows per key and pane (a tumbling window of ``slide``,
    append mode: the panes of a batch are all newer than those of the batches before).  Every
    micro-batch with finished panes writes them to ``<panes_path>/panes_<newest>`` and its windows, up to the
    one that ends with its newest pane, to ``<out_path>/batch_id=<n>``.  For these it needs the counts
    of the last window before it (``carry_<newest>``, a row per key), its own panes, and the folders of
    the panes that leave the window: what it reads does not grow with the stream.  Panes
    that no later or repeated batch can need are removed.  A replayed batch replaces its own
    folders.  Windows after the newest pane follow with a later batch, or with
    ``finish_sliding_counts``.
    """
    slide_us = int(round(slide_s * 1_000_000))
    panes = (df.withWatermark(ts, f"{int(round(delay_s * 1000))} milliseconds")
             .groupBy(*keys, F.window(ts, f"{slide_us} microseconds").alias("__w"))
             .agg(F.count(F.lit(1)).alias("__c"))
             .select(*keys, F.call_function("div", F.unix_micros("__w.start"), F.lit(slide_us).cast("bigint")).alias("__pane"),
                     "__c"))

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        try:
            newest = batch.agg(F.max("__pane")).first()[0]
            if newest is not None:
                _slide(batch, newest, keys, size_s, slide_s, panes_path.rstrip("/"),
                       f"{out_path.rstrip('/')}/batch_id={batch_id}", count_col)
        finally:
            batch.unpersist()

    return foreach_batch(panes, write, name, "append", checkpoint, trigger)


def _slide(batch: DataFrame, newest: int, keys: list[str], size_s: float, slide_s: float, folder: str, out: str,
           count_col: str) -> None:
    """The windows behind those of the batch before, up to the one that ends with pane ``newest``."""
    from tidemark.operators.windows import window_ratio

    spark, ratio = batch.sparkSession, window_ratio(size_s, slide_s)
    batch.write.mode("overwrite").parquet(f"{folder}/panes_{newest}")
    before = [n for n in _folders(spark, folder, "panes_") if n < newest]
    seen = before[-1] if before else None
    runs = _runs_behind(batch, before, newest + 1, keys, ratio, folder).persist()
    try:
        _write_windows(runs, seen, keys, slide_s, out, count_col)
        runs.filter(F.col("__next") == newest + 2).select(*keys, F.col("__run").cast("bigint").alias("__c")) \
            .write.mode("overwrite").parquet(f"{folder}/carry_{newest}")
    finally:
        runs.unpersist()
    if before:
        # this batch, if repeated, reads the panes from seen + 1 - ratio on and the carry of seen
        for n in before:
            if n < seen + 1 - ratio:
                _delete(spark, f"{folder}/panes_{n}")
        for n in _folders(spark, folder, "carry_"):
            if n < seen:
                _delete(spark, f"{folder}/carry_{n}")


def _runs_behind(fresh: DataFrame, before: list[int], last_end: int, keys: list[str], ratio: int, folder: str) -> DataFrame:
    """Runs ``keys, __e, __next, __run`` of windows that end at a slide up to ``last_end``, from the
    carry of the newest folder in ``before``, the panes that leave and the ``fresh`` ones.  Folder n holds
    the panes after those of the folder before it."""
    from tidemark.operators.windows import runs_from_deltas

    spark, end = fresh.sparkSession, F.lit(last_end).cast("bigint")
    arrive = fresh.select(*keys, (F.col("__pane") + 1).alias("__e"), F.col("__c").alias("__d"))
    leave = fresh
    if before:
        seen = before[-1]
        files = [f"{folder}/panes_{n}" for i, n in enumerate(before)
                 if n > seen - ratio and (i == 0 or before[i - 1] + 1 < last_end - ratio)]
        if files:
            old = spark.read.schema(fresh.schema).parquet(*files)
            leave = fresh.unionByName(old.filter(F.col("__pane") > seen - ratio))
        carry = spark.read.schema(fresh.drop("__pane").schema).parquet(f"{folder}/carry_{seen}")
        arrive = arrive.unionByName(carry.select(*keys, F.lit(seen + 1).cast("bigint").alias("__e"), F.col("__c").alias("__d")))
    deltas = arrive.unionByName(leave.select(*keys, (F.col("__pane") + ratio + 1).alias("__e"), (-F.col("__c")).alias("__d")))
    changes = deltas.filter(F.col("__e") <= end).groupBy(*keys, "__e").agg(F.sum("__d").alias("__d"))
    # a count that nothing changes any more holds up to last_end
    return runs_from_deltas(changes, keys).withColumn("__next", F.coalesce("__next", end + 1))


def _write_windows(runs: DataFrame, seen: int | None, keys: list[str], slide_s: float, out: str, count_col: str) -> None:
    first = F.col("__e") if seen is None else F.greatest(F.col("__e"), F.lit(seen + 2).cast("bigint"))
    ends = F.when(first < F.col("__next"), F.sequence(first, F.col("__next") - 1))
    (runs.select(*keys, F.explode(ends).alias("__end"), F.col("__run").cast("bigint").alias(count_col))
     .select(*keys, (F.col("__end") * F.lit(int(round(slide_s * 1000)))).cast("bigint").alias("window_end_ms"), count_col)
     .write.mode("overwrite").parquet(out))


def finish_sliding_counts(spark: SparkSession, keys: list[str], size_s: float, slide_s: float, panes_path: str,
                          out_path: str, count_col: str = "cnt") -> None:
    """The closing mark of a stopped ``sliding_counts_each_batch``: write the windows that end behind
    its newest pane to ``<out_path>/batch_id=-1``.  What is stored stays; a stream that is resumed
    writes these windows itself, so remove that folder first."""
    from tidemark.operators.windows import window_ratio

    folder = panes_path.rstrip("/")
    stored = _folders(spark, folder, "panes_")
    if not stored:
        return
    ratio = window_ratio(size_s, slide_s)
    none = spark.read.parquet(f"{folder}/panes_{stored[-1]}").limit(0)
    runs = _runs_behind(none, stored, stored[-1] + ratio + 1, keys, ratio, folder)
    _write_windows(runs, stored[-1], keys, slide_s, f"{out_path.rstrip('/')}/batch_id=-1", count_col)
