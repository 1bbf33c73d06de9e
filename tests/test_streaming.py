import numpy as np
import pytest
from pyspark.sql import functions as F

from noisefield.operators import stack
from noisefield.sources import store
from noisefield.streaming import incremental


def test_stream_equals_batch_and_takes_in_new_files(spark, tmp_path):
    rows = [(1, 0, k, float(k * d)) for d in range(4) for k in range(3)]
    df = spark.createDataFrame(rows, "path_id long, slot int, lag int, v double")
    source, table, progress = (str(tmp_path / x) for x in ("in", "table", "progress"))
    for part in (df.where("v < 3"), df.where("v >= 3")):
        part.coalesce(1).write.mode("append").parquet(source)
        incremental.materialize(incremental.read_stream(spark, source, df.schema, 1), table, progress).awaitTermination()
    want = {(r.lag, r.n, r.v) for r in incremental.linear_updates(df).collect()}
    assert {(r.lag, r.n, r.v) for r in incremental.stack_of(spark, table).collect()} == want


def test_sums_are_put_together(spark, tmp_path):
    source, table, progress = (str(tmp_path / x) for x in ("in", "table", "progress"))
    total = {}
    for day in range(7):
        df = spark.createDataFrame([(1, 0, k, float(k + day)) for k in range(3)], "path_id long, slot int, lag int, v double")
        df.coalesce(1).write.mode("append").parquet(source)
        for k in range(3):
            total.setdefault(k, []).append(float(k + day))
        incremental.materialize(incremental.read_stream(spark, source, df.schema, 1), table, progress, every=2).awaitTermination()
        assert {r.lag: (r.n, r.v) for r in incremental.stack_of(spark, table).collect()} == {k: (len(v), sum(v) / len(v)) for k, v in total.items()}
    assert store.folders(spark, table) == ["batch=4", "batch=5", "batch=6", "upto=3", "upto=5"]
    # a batch that runs again, its part half written, leaves the same sums
    store.remove(spark, f"{table}/upto=5/_SUCCESS")
    incremental._put_together(spark, table, 5, incremental.KEYS)
    assert {r.lag: r.n for r in incremental.stack_of(spark, table).collect()} == {0: 7, 1: 7, 2: 7}


WIDTH = 33


@pytest.fixture(scope="module")
def records(spark):
    rng = np.random.default_rng(8)
    common = np.sin(np.arange(WIDTH) / 2)
    rows = [(t, 10002 + p, s, (common + rng.normal(size=WIDTH)).tolist()) for t in range(11) for p in range(2) for s in (0, 4) if (t, p) != (3, 1)]
    return spark.createDataFrame(rows, "timestamp long, path_id long, slot int, data array<double>")


@pytest.mark.parametrize("how", [stack.Phases(WIDTH), stack.LocalPhases(WIDTH, band=(0.05, 0.3), taper=0.02)], ids=["phases", "local"])
@pytest.mark.parametrize("edges", [[4], [1, 2, 3, 9], [5, 6]])
def test_any_split_gives_the_stack_of_all(spark, records, tmp_path, how, edges):
    whole = stack.phase_weighted_stack(records, 4, WIDTH) if isinstance(how, stack.LocalPhases) is False else stack.time_frequency_stack(records, 4, WIDTH, band=(0.05, 0.3), taper=0.02)
    want = {(r.path_id, r.slot): r for r in whole.collect()}
    source, table, progress = (str(tmp_path / x) for x in ("in", "table", "progress"))
    for low, high in zip([0, *edges], [*edges, 99], strict=True):
        records.where(f"timestamp >= {low} and timestamp < {high}").orderBy(F.desc("timestamp")).coalesce(1).write.mode("append").parquet(source)
        incremental.materialize_weighted(incremental.read_stream(spark, source, records.schema, 1), how, 4, table, progress).awaitTermination()
    got = {(r.path_id, r.slot): r for r in incremental.weighted_stack_of(spark, table, how).collect()}
    assert got.keys() == want.keys()
    for k, r in got.items():
        assert (r.n, r.chunks) == (want[k].n, want[k].chunks) == ((11, 3) if k[0] == 10002 else (10, 3)) and r.data == pytest.approx(want[k].data, abs=1e-9)


def test_late_and_repeated_records_are_refused(spark, records, tmp_path):
    source, table, progress = (str(tmp_path / x) for x in ("in", "table", "progress"))
    how = stack.Phases(WIDTH)
    for part in ("timestamp < 5", "timestamp in (2, 4) or timestamp >= 5", "timestamp = 10"):
        records.where(part).coalesce(1).write.mode("append").parquet(source)
        incremental.materialize_weighted(incremental.read_stream(spark, source, records.schema, 1), how, 4, table, progress).awaitTermination()
    want = {(r.path_id, r.slot): r.data for r in stack.phase_weighted_stack(records, 4, WIDTH).collect()}
    got = {(r.path_id, r.slot): r.data for r in incremental.weighted_stack_of(spark, table, how).collect()}
    assert all(got[k] == pytest.approx(want[k], abs=1e-9) for k in want)
    assert {r.late for r in spark.read.parquet(table).where("batch = 2").collect()} == {3}


def test_phasors_are_not_shuffled(spark, records):
    """What is exchanged are records and chunks: no exchange below the task that sums phasors carries more than the chunks' own columns."""
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = stack.phase_weighted_stack(records, 4, WIDTH)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
    above = plan[: plan.index("FlatMapGroupsInArrow")]
    assert "Exchange" not in above and "phasors" not in plan


def test_windows_close_once_and_late_rows_are_dropped(spark, tmp_path):
    source, table, progress = (str(tmp_path / x) for x in ("in", "table", "progress"))
    def take(*rows):
        df = spark.createDataFrame([(f"2022-05-01 {t}", k) for t, k in rows], "t string, kind string")
        df.select(F.col("t").cast("timestamp").alias("t"), "kind").coalesce(1).write.mode("append").parquet(source)
        counts = incremental.windowed_counts(incremental.read_stream(spark, source, "t timestamp, kind string", 1), "t", "2 hours", "1 hour", "kind")
        incremental.materialize_windows(counts, table, progress).awaitTermination()
        return sorted((r.window.start.hour, r.kind, r.n) for r in incremental.windows_of(spark, table).collect())

    assert take(("01:10", "a"), ("01:50", "a"), ("02:30", "b")) == []
    # at 04:30 the window from 01:00 is closed, that from 02:00 is open still
    assert take(("04:30", "a")) == [(1, "a", 2)]
    # one row comes too late; another is as old as the watermark allows
    assert take(("01:20", "a"), ("02:40", "b"), ("07:00", "a")) == [(1, "a", 2), (2, "b", 2), (4, "a", 1)]
    assert take(("02:10", "b"), ("09:30", "b")) == [(1, "a", 2), (2, "b", 2), (4, "a", 1)]


def test_window_query(same_as_sql):
    from noisefield.plans import catalog

    same_as_sql(catalog.stream_window_counts, catalog.SQL["stream_window_counts"])
