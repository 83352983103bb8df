"""Stream result equals the batch twin however the polls arrive."""

import datetime as dt
import random
import tempfile

import pytest

from vistaframe.operators.joins import anti_join_previous
from vistaframe.streaming import snapshots as SN

DAYS = [dt.date(2020, 1, i) for i in range(1, 9)]
ROWS = [("s", DAYS[0], "a"), ("s", DAYS[0], "b"), ("t", DAYS[0], "x"),
        ("s", DAYS[1], None), ("t", DAYS[1], "x"), ("t", DAYS[1], "y"),
        ("s", DAYS[2], "a"), ("s", DAYS[2], "c"), ("t", DAYS[2], None),
        ("s", DAYS[3], "c"), ("t", DAYS[3], "x"),
        ("s", DAYS[4], "a"), ("t", DAYS[4], "z"), ("s", DAYS[5], None), ("t", DAYS[5], "z"), ("s", DAYS[6], "b")]


def write_files(spark, base, groups):
    """One file per group of rows, picked up in this order."""
    for g in groups:
        spark.createDataFrame(g, SN.SCHEMA).coalesce(1).write.mode("append").parquet(f"{base}/polls")


def run(spark, base, max_files, **options):
    SN.start_delta_query(spark, f"{base}/polls", f"{base}/out", f"{base}/ckpt", max_files=max_files, **options).awaitTermination()


def result(spark, base):
    return sorted(tuple(r) for r in SN.read_output(spark, f"{base}/out").collect())


@pytest.fixture(scope="module")
def want(spark):
    df = spark.createDataFrame(ROWS, SN.SCHEMA)
    return sorted(tuple(r) for r in anti_join_previous(df, skip_empty=True).select("site", "snapshot", "item").collect())


@pytest.mark.parametrize("max_files", [1, 2, 3])
def test_polls_in_several_files(spark, want, max_files):
    """Every row is a file of its own, so a poll spans batches."""
    base = tempfile.mkdtemp(prefix="vf-stream-")
    write_files(spark, base, [[r] for r in ROWS])
    run(spark, base, max_files)
    assert result(spark, base) == want


def test_two_polls_of_two_items(spark):
    base = tempfile.mkdtemp(prefix="vf-stream-")
    write_files(spark, base, [[("s", d, i)] for d in DAYS[:2] for i in "ab"])
    run(spark, base, 1)
    assert result(spark, base) == [("s", DAYS[0], "a"), ("s", DAYS[0], "b")]


def test_late_pieces_correct_earlier_output(spark, want):
    base = tempfile.mkdtemp(prefix="vf-stream-")
    rows = list(ROWS)
    random.Random(4).shuffle(rows)
    write_files(spark, base, [rows[i:i + 3] for i in range(0, len(rows), 3)])
    run(spark, base, 1)
    assert result(spark, base) == want


def test_too_late_rows_are_set_aside(spark):
    base = tempfile.mkdtemp(prefix="vf-stream-")
    write_files(spark, base, [[("s", d, "a")] for d in DAYS[:4]] + [[("s", DAYS[0], "q")]])
    run(spark, base, 1, keep_polls=2)
    assert result(spark, base) == [("s", DAYS[0], "a")]
    late = spark.read.parquet(f"{base}/out/late").collect()
    assert [(r["site"], r["snapshot"], r["item"]) for r in late] == [("s", DAYS[0], "q")]


def test_kill_between_delta_and_state(spark, want):
    base = tempfile.mkdtemp(prefix="vf-stream-")
    write_files(spark, base, [[r] for r in ROWS])
    killed = []

    def kill(batch_id):
        if batch_id in (2, 5) and batch_id not in killed:
            killed.append(batch_id)
            raise RuntimeError("killed")

    for _ in range(3):
        try:
            run(spark, base, 2, after_delta=kill)
        except Exception as e:  # noqa: BLE001
            assert "killed" in str(e)
    assert killed == [2, 5] and result(spark, base) == want
    versions = SN._state_versions(spark, f"{base}/out/state", 10**6)
    assert len(versions) <= 2  # older ones are removed


def test_restart_adds_nothing(spark, want):
    base = tempfile.mkdtemp(prefix="vf-stream-")
    SN.write_poll_files(spark.createDataFrame(ROWS, SN.SCHEMA), f"{base}/polls", files=4)
    for _ in range(2):
        run(spark, base, 2)
        assert result(spark, base) == want


def test_long_deltas_make_numbered_messages(spark):
    delta = spark.createDataFrame([("s", DAYS[0], f"i{k:02d}") for k in range(25)], SN.SCHEMA)
    got = SN.alerts(delta, part_items=10).orderBy("part").collect()
    assert [r["part"] for r in got] == [0, 1, 2]
    assert [len(r["message"].split(",")) for r in got] == [10, 10, 5]


def sent(spark, base):
    return sorted((tuple(r) for r in SN.read_alerts(spark, f"{base}/out").collect()), key=str)


def log(spark, base):
    return sorted((tuple(r) for r in SN.read_alert_log(spark, f"{base}/out").collect()), key=str)


@pytest.fixture(scope="module")
def want_alerts(spark, want):
    return sorted((tuple(r) for r in SN.alerts(spark.createDataFrame(want, SN.SCHEMA)).select(
        "site", "snapshot", "part", "message", "stamp").collect()), key=str)


def test_alerts_are_there_after_each_batch(spark, want_alerts):
    base = tempfile.mkdtemp(prefix="vf-stream-")
    by_day = [[r for r in ROWS if r[1] == d] for d in DAYS if any(r[1] == d for r in ROWS)]
    for k, rows in enumerate(by_day):
        write_files(spark, base, [rows])
        run(spark, base, 1, with_alerts=True)
        assert sent(spark, base) == [a for a in want_alerts if a[1] <= rows[0][1]], k
    assert {r[5] for r in log(spark, base)} == {"send"}  # nothing came late


def test_late_pieces_retract_alerts(spark):
    base = tempfile.mkdtemp(prefix="vf-stream-")
    write_files(spark, base, [[("s", DAYS[0], "a")], [("s", DAYS[2], "a"), ("s", DAYS[2], "b")]])
    run(spark, base, 1, with_alerts=True)
    assert [a[1:4] for a in sent(spark, base)] == [(DAYS[0], 0, "s update! a"), (DAYS[2], 0, "s update! b")]
    write_files(spark, base, [[("s", DAYS[1], "b"), ("s", DAYS[1], "c")]])  # between the two: b was new there, a is new after it
    run(spark, base, 1, with_alerts=True)
    assert [a[1:4] for a in sent(spark, base)] == [
        (DAYS[0], 0, "s update! a"), (DAYS[1], 0, "s update! b, c"), (DAYS[2], 0, "s update! a")]
    assert [(r[3], r[5]) for r in log(spark, base) if r[6] == 2 and r[1] == DAYS[2]] == [
        ("s update! a", "send"), ("s update! b", "retract")]
    write_files(spark, base, [[("s", DAYS[1], "a")]])  # now nothing is new on the third day
    run(spark, base, 1, with_alerts=True)
    assert [a[1:4] for a in sent(spark, base)] == [(DAYS[0], 0, "s update! a"), (DAYS[1], 0, "s update! b, c")]


def test_alerts_however_polls_arrive(spark, want_alerts):
    base = tempfile.mkdtemp(prefix="vf-stream-")
    rows = list(ROWS)
    random.Random(9).shuffle(rows)
    write_files(spark, base, [rows[i:i + 3] for i in range(0, len(rows), 3)])
    run(spark, base, 1, with_alerts=True)
    assert sent(spark, base) == want_alerts


@pytest.mark.parametrize("step", ["after_stage", "after_delta"])
def test_replay_sends_nothing_twice(spark, want_alerts, step):
    """Killed between staging and commit: nothing of the batch is readable;
    after the commit: the replay adds nothing."""
    base = tempfile.mkdtemp(prefix="vf-stream-")
    write_files(spark, base, [[r for r in ROWS if r[1] == d] for d in DAYS[:4]])
    killed = []

    def kill(batch_id):
        if batch_id == 2 and not killed:
            killed.append(log(spark, base))
            raise RuntimeError("killed")

    with pytest.raises(Exception, match="killed"):
        run(spark, base, 1, with_alerts=True, **{step: kill})
    assert max((r[6] for r in killed[0]), default=-1) < (2 if step == "after_stage" else 3)
    run(spark, base, 1, with_alerts=True)
    assert sent(spark, base) == [a for a in want_alerts if a[1] <= DAYS[3]]
    whole = log(spark, base)
    assert len(whole) == len(set(r[:6] for r in whole)) and set(killed[0]) <= set(whole)
