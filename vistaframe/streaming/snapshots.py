"""Snapshot-change detection on a stream of polls.

Each poll delivers ``(site, snapshot, item)`` rows; an empty poll is one
marker row with a NULL item. For every site, items of a non-empty poll that
were not in the site's previous NON-EMPTY poll are "new"; an empty poll
never replaces what was seen; an item that vanishes and returns is new again.

Execution: a stateless ``readStream`` feeding ``foreachBatch``. A poll may
arrive in any number of pieces over several batches, and pieces may arrive
after a later poll. The state holds, per site, the last ``keep_polls``
non-empty polls; a batch recomputes the deltas of the polls it touches and of
the poll after each of them, and writes them as a new version of those polls.
Readers take a poll's latest version. Rows of a poll that is not newer than
the oldest poll kept (once a site has ``keep_polls`` of them) can't be compared
any more: they go to ``late`` and change nothing.

The state is a parquet table in the shared folder, versioned by batch id. A
batch reads the newest version older than itself, so a replayed batch (after a
lost executor or a restart, also between the writes of one batch) recomputes
the same output and overwrites its own partition. Versions that no replay can
need are removed. State and deltas are ordinary distributed DataFrames.

Alerts leave the stream with each batch, in two steps: the batch's messages are
staged under its id, then a commit row makes them readable. A message that a
late piece changes is retracted in the batch that sends its replacement. A
replayed batch finds its commit and sends nothing again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import scalars as X
from ..operators.joins import anti_join_previous
from ..session import path_exists

SCHEMA = "site STRING, snapshot DATE, item STRING"
KEEP_POLLS = 8
ALERT_ITEMS = 1000  # items of one message; more of them are numbered parts


def write_poll_files(df: DataFrame, path: str, snapshots: list | None = None, files: int | None = None) -> None:
    """Fixture writer: the rows of the given polls (all by default) as files
    that hold neighbouring polls, in one write. A poll may span files."""
    if snapshots is not None:
        df = df.filter(F.col("snapshot").between(F.lit(min(snapshots)), F.lit(max(snapshots))))
    order = ["snapshot", "site"]
    ranged = df.repartitionByRange(files, *order) if files else df.repartitionByRange(*order)
    ranged.sortWithinPartitions(*order).write.mode("append").parquet(path)


def poll_stream(spark: SparkSession, path: str, max_files: int | None = 1) -> DataFrame:
    r = spark.readStream.schema(SCHEMA).format("parquet")
    if max_files:
        r = r.option("maxFilesPerTrigger", max_files)
    return r.load(path)


def _state_versions(spark: SparkSession, state_dir: str, before: int) -> list[int]:
    """Complete versions older than ``before``, in order."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(state_dir)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(p):
        return []
    versions = []
    for st in fs.listStatus(p):
        name = st.getPath().getName()
        if name.startswith("v=") and fs.exists(jvm.org.apache.hadoop.fs.Path(st.getPath(), "_SUCCESS")):
            versions.append(int(name[2:]))
    return sorted(v for v in versions if v < before)


def _remove_versions(spark: SparkSession, state_dir: str, versions: list[int]) -> None:
    jvm = spark.sparkContext._jvm
    for v in versions:
        p = jvm.org.apache.hadoop.fs.Path(f"{state_dir}/v={v}")
        p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def split_late(batch: DataFrame, state: DataFrame | None, keep_polls: int = KEEP_POLLS) -> tuple[DataFrame, DataFrame]:
    """(rows that can still be compared, late rows)."""
    if state is None:
        return batch, batch.limit(0)
    kept = state.groupBy("site").agg(F.min("snapshot").alias("__oldest"), F.countDistinct("snapshot").alias("__polls"))
    kept = kept.filter(F.col("__polls") >= keep_polls).withColumnRenamed("site", "__site")
    known = batch.join(kept, batch["site"].eqNullSafe(kept["__site"]), "left")
    late = F.coalesce(F.col("snapshot") <= F.col("__oldest"), F.lit(False))
    return known.filter(~late).select(*batch.columns), known.filter(late).select(*batch.columns)


def delta_batch(batch: DataFrame, state: DataFrame | None, keep_polls: int = KEEP_POLLS):
    """``(polls, delta, new_state)`` of a batch given the state: the polls
    whose delta is computed anew, their new items, the polls kept per site."""
    cur = batch.select("site", "snapshot", "item")
    combined = (cur if state is None else cur.unionByName(state.select("site", "snapshot", "item"))).distinct()
    present = combined.filter(F.col("item").isNotNull()).select("site", "snapshot").distinct()
    touched = cur.filter(F.col("item").isNotNull()).select("site", "snapshot", F.lit(True).alias("__touched")).distinct()
    by_time = Window.partitionBy("site").orderBy("snapshot")
    same = (present["site"].eqNullSafe(touched["site"])) & (present["snapshot"] == touched["snapshot"])
    marked = present.join(touched, same, "left").select(present["site"], present["snapshot"], "__touched")
    polls = (marked.withColumn("__before", F.lag("__touched").over(by_time))
             .filter(F.coalesce("__touched", F.lit(False)) | F.coalesce("__before", F.lit(False)))
             .select("site", "snapshot"))
    delta = anti_join_previous(combined, skip_empty=True).select("site", "snapshot", "item")
    renamed = polls.select(F.col("site").alias("__s"), F.col("snapshot").alias("__t"))
    delta = delta.join(renamed, delta["site"].eqNullSafe(renamed["__s"]) & (delta["snapshot"] == renamed["__t"]), "left_semi")
    newest = Window.partitionBy("site").orderBy(F.col("snapshot").desc())
    last = (present.withColumn("__rk", F.row_number().over(newest)).filter(F.col("__rk") <= keep_polls)
            .select(F.col("site").alias("__s"), F.col("snapshot").alias("__t")))
    nonempty = combined.filter(F.col("item").isNotNull())
    new_state = nonempty.join(last, nonempty["site"].eqNullSafe(last["__s"]) & (nonempty["snapshot"] == last["__t"]), "left_semi")
    return polls, delta, new_state


def alerts(delta: DataFrame, stamp_format: str = "dd/MM/yyyy HH:mm:ss", part_items: int = ALERT_ITEMS) -> DataFrame:
    """Messages per (site, poll) with a non-empty delta: ``<site> update! a,
    b`` plus the poll time stamp. More than ``part_items`` items make several
    numbered parts, each of a bounded number of items."""
    order = Window.partitionBy("site", "snapshot").orderBy("item")
    numbered = delta.withColumn("part", F.floor((F.row_number().over(order) - 1) / part_items).cast("int"))
    g = numbered.groupBy("site", "snapshot", "part").agg(F.collect_list("item").alias("items"))
    return g.select("site", "snapshot", "part", X.alert_text(F.col("site"), F.col("items")).alias("message"),
                    F.date_format(F.col("snapshot").cast("timestamp"), stamp_format).alias("stamp"))


def changed_alerts(delta: DataFrame, polls: DataFrame, state: DataFrame | None, part_items: int = ALERT_ITEMS) -> DataFrame:
    """What a batch has to say: messages of its ``delta`` not sent before
    (``send``), and those sent before for one of its ``polls`` that hold no more
    (``retract``). What was sent follows from the state before the batch: a poll
    that is not late has the one before it there, if it had one."""
    new = alerts(delta, part_items=part_items)
    if state is None:
        return new.withColumn("action", F.lit("send"))
    renamed = polls.select(F.col("site").alias("__s"), F.col("snapshot").alias("__t"))
    before = anti_join_previous(state, skip_empty=True).select("site", "snapshot", "item")
    before = before.join(renamed, before["site"].eqNullSafe(renamed["__s"]) & (before["snapshot"] == renamed["__t"]), "left_semi")
    old = alerts(before, part_items=part_items)
    return new.subtract(old).withColumn("action", F.lit("send")).unionByName(
        old.subtract(new).withColumn("action", F.lit("retract")))


def _send_alerts(changes: DataFrame, out_dir: str, batch_id: int, after_stage=None) -> None:
    spark = changes.sparkSession
    commit = f"{out_dir}/alert_commits/batch={batch_id}"
    if path_exists(spark, f"{commit}/_SUCCESS"):
        return
    changes.write.mode("overwrite").parquet(f"{out_dir}/alerts/batch={batch_id}")
    if after_stage:
        after_stage(batch_id)
    spark.range(1).select(F.current_timestamp().alias("at")).coalesce(1).write.mode("overwrite").parquet(commit)


def start_delta_query(spark: SparkSession, polls_dir: str, out_dir: str, checkpoint: str,
                      max_files: int | None = 1, available_now: bool = True,
                      processing_time: str = "90 seconds", keep_polls: int = KEEP_POLLS, after_delta=None,
                      with_alerts: bool = False, after_stage=None):
    """Start the change-detection stream. Outputs (parquet, one partition per
    batch id): ``{out}/polls`` (versions), ``{out}/delta``, ``{out}/late``,
    if asked for ``{out}/alerts`` with ``{out}/alert_commits``; state under
    ``{out}/state``. ``after_delta(batch_id)`` runs between the writes of output
    and state, ``after_stage(batch_id)`` between the two steps of the alerts
    (for tests of recovery)."""
    state_dir = f"{out_dir}/state"

    def process(batch: DataFrame, batch_id: int) -> None:
        versions = _state_versions(spark, state_dir, batch_id)
        prev = spark.read.schema(SCHEMA).parquet(f"{state_dir}/v={versions[-1]}") if versions else None
        timely, late = split_late(batch, prev, keep_polls)
        polls, delta, new_state = delta_batch(timely, prev, keep_polls)
        late.write.mode("overwrite").parquet(f"{out_dir}/late/batch={batch_id}")
        delta.write.mode("overwrite").parquet(f"{out_dir}/delta/batch={batch_id}")
        polls.write.mode("overwrite").parquet(f"{out_dir}/polls/batch={batch_id}")
        if with_alerts:  # from what was just written: nothing is computed twice
            written = [spark.read.schema(t.schema).parquet(f"{out_dir}/{n}/batch={batch_id}") for n, t in
                       (("delta", delta), ("polls", polls))]
            _send_alerts(changed_alerts(*written, prev), out_dir, batch_id, after_stage)
        if after_delta:
            after_delta(batch_id)
        new_state.write.mode("overwrite").parquet(f"{state_dir}/v={batch_id}")
        _remove_versions(spark, state_dir, versions[:-1])  # a replay of this batch reads the last of them

    w = poll_stream(spark, polls_dir, max_files).writeStream.foreachBatch(process) \
        .option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime=processing_time)
    return w.start()


ALERT_SCHEMA = "site STRING, snapshot DATE, part INT, message STRING, stamp STRING"


def read_alert_log(spark: SparkSession, out_dir: str) -> DataFrame:
    """Every committed ``send`` and ``retract``, with its batch."""
    if not path_exists(spark, f"{out_dir}/alert_commits"):
        return spark.createDataFrame([], ALERT_SCHEMA + ", action STRING, batch INT")
    commits = spark.read.schema("at TIMESTAMP, batch INT").parquet(f"{out_dir}/alert_commits").select("batch").distinct()
    log = spark.read.schema(ALERT_SCHEMA + ", action STRING, batch INT").parquet(f"{out_dir}/alerts")
    return log.join(commits, "batch", "left_semi").select(
        "site", "snapshot", "part", "message", "stamp", "action", "batch")


def read_alerts(spark: SparkSession, out_dir: str) -> DataFrame:
    """The messages that hold: per part of a poll the last one sent, unless it
    was retracted since."""
    newest = F.max(F.struct("batch", (F.col("action") == "send").alias("sent"), "message", "stamp")).alias("m")
    live = read_alert_log(spark, out_dir).groupBy("site", "snapshot", "part").agg(newest).filter("m.sent")
    return live.select("site", "snapshot", "part", "m.message", "m.stamp")


def read_output(spark: SparkSession, out_dir: str) -> DataFrame:
    """New items, each poll's in its latest version."""
    if not path_exists(spark, f"{out_dir}/polls"):
        return spark.createDataFrame([], SCHEMA)
    polls = spark.read.schema("site STRING, snapshot DATE, batch INT").parquet(f"{out_dir}/polls")
    latest = polls.groupBy("site", "snapshot").agg(F.max("batch").alias("__b")).select(
        F.col("site").alias("__s"), F.col("snapshot").alias("__t"), "__b")
    delta = spark.read.schema(SCHEMA + ", batch INT").parquet(f"{out_dir}/delta")
    same = delta["site"].eqNullSafe(latest["__s"]) & (delta["snapshot"] == latest["__t"]) & (delta["batch"] == latest["__b"])
    return delta.join(latest, same, "left_semi").select("site", "snapshot", "item")


def start_filter_query(spark: SparkSession, polls_dir: str, out_dir: str, checkpoint: str, patterns: list[str],
                       max_files: int | None = 1):
    """Stateless stream: drop items matching any pattern (case-insensitive)
    into an exactly-once parquet file sink."""
    s = poll_stream(spark, polls_dir, max_files)
    kept = s.filter(F.col("item").isNotNull() & ~X.matches_any("item", patterns, case_insensitive=True))
    return (kept.writeStream.format("parquet").option("path", out_dir)
                .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
