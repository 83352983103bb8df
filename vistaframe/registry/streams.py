"""Streaming queries: each writes the polls (from ``events``) as files in a
few arrival steps, runs the stream to completion with ``availableNow`` and
returns the sink."""

from __future__ import annotations

from ..plans import adapters as A
from ..session import scratch_path
from ..streaming import snapshots as SN
from ._base import register
from .joins import delta_sql
from .text import BLACKLIST

STEP_POLLS = 6  # polls that arrive together, fewer than the state keeps


def _stream(spark, sf, tag, max_files, steps_at_once, with_alerts=False):
    """Polls arrive in steps of STEP_POLLS dates; a run of the stream follows
    every ``steps_at_once`` steps, from the same checkpoint. -> output folder"""
    base = scratch_path(spark, f"stream-{tag}")
    snap = A.snapshots(spark, sf)
    snap.write.parquet(f"{base}/source")  # the table is scanned once, not per step
    source = spark.read.schema(SN.SCHEMA).parquet(f"{base}/source")
    dates = [r[0] for r in source.select("snapshot").distinct().orderBy("snapshot").collect()]  # the calendar
    steps = [dates[i:i + STEP_POLLS] for i in range(0, len(dates), STEP_POLLS)]
    for k, step in enumerate(steps):
        SN.write_poll_files(source, f"{base}/polls", step, files=3)
        if (k + 1) % steps_at_once == 0 or k + 1 == len(steps):
            SN.start_delta_query(spark, f"{base}/polls", f"{base}/out", f"{base}/ckpt", max_files=max_files,
                                 with_alerts=with_alerts).awaitTermination()
    return f"{base}/out"


@register("stream_filter_items", delta_sql(False).split("nums AS")[0].rstrip().rstrip(",") + """
SELECT site, snapshot, item FROM snapshots WHERE item IS NOT NULL AND NOT regexp_matches(item, '(?i)USER-1$|USER-7$')""")
def stream_filter_items(spark, sf):
    base = scratch_path(spark, "stream-filter")
    SN.write_poll_files(A.snapshots(spark, sf), f"{base}/polls")
    q = SN.start_filter_query(spark, f"{base}/polls", f"{base}/out", f"{base}/ckpt", BLACKLIST, max_files=None)
    q.awaitTermination()
    return spark.read.schema(SN.SCHEMA).parquet(f"{base}/out")


@register("stream_snapshot_delta", delta_sql(True) + "SELECT * FROM delta")
def stream_snapshot_delta(spark, sf):
    return SN.read_output(spark, _stream(spark, sf, "delta", max_files=1, steps_at_once=1))


@register("stream_alert_sink", delta_sql(True) + f"""
SELECT site, snapshot, CAST(part AS INT) AS part, site || ' update! ' || array_to_string(list_sort(list(item)), ', ') AS message,
  strftime(CAST(snapshot AS TIMESTAMP), '%d/%m/%Y %H:%M:%S') AS stamp
FROM (SELECT *, (row_number() OVER (PARTITION BY site, snapshot ORDER BY item) - 1) // {SN.ALERT_ITEMS} AS part FROM delta)
GROUP BY site, snapshot, part""")
def stream_alert_sink(spark, sf):
    """The messages that the stream itself has sent and not retracted."""
    return SN.read_alerts(spark, _stream(spark, sf, "alerts", max_files=3, steps_at_once=1, with_alerts=True))


@register("stream_recover", delta_sql(True) + "SELECT * FROM delta")
def stream_recover(spark, sf):
    """Three steps of polls per run: the stream stops and starts again from
    its checkpoint, and the result equals a single uninterrupted run."""
    return SN.read_output(spark, _stream(spark, sf, "recover", max_files=2, steps_at_once=3))
