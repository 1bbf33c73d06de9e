import pytest

from noisefield.sources import store
from noisefield.streaming import incremental, indexes


def _record(t, path, slot, offset=0, pack="a.sac"):
    return (t, path, slot, pack, offset, 700, None)


def _mark(t, n):
    return (t, None, None, None, None, None, n)


class Feed:
    def __init__(self, spark, base):
        self.spark, self.rows, self.folder, self.progress = spark, str(base / "rows"), str(base / "made"), str(base / "progress")

    def take(self, *batches, tidy_every=16):
        for rows in batches:
            self.spark.createDataFrame(rows, indexes.SCHEMA).coalesce(1).write.mode("append").parquet(self.rows)
        indexes.materialize(incremental.read_stream(self.spark, self.rows, indexes.SCHEMA, 1), self.folder, self.progress, tidy_every).awaitTermination()

    def index(self):
        return sorted((r.timestamp, r.path_id, r.slot, r.record_path, r.record_offset) for r in indexes.index_of(self.spark, self.folder).collect())

    def closed(self):
        return {r.timestamp: (r.records, r.repeated, r.surplus, r.built) for r in indexes.closed(self.spark, self.folder).collect()}


def test_each_index_is_written_once_when_its_timestamp_is_finished(spark, tmp_path):
    f = Feed(spark, tmp_path)
    f.take([_record("t1", 2, 0, 5), _record("t2", 1, 0), _mark("t1", 2)])
    assert f.index() == [] and f.closed() == {}
    assert {(r.timestamp, r.expected, r.records, r.first_batch) for r in indexes.unfinished(spark, f.folder).collect()} == {("t1", 2, 1, 0), ("t2", None, 1, 0)}
    with pytest.raises(ValueError, match=r"2 timestamps are not finished, among them t1 \(1 of 2\)"):
        indexes.finish(spark, f.folder)
    # a repeated record does not count; the one with the least place stays
    f.take([_record("t1", 2, 0, 3), _record("t2", 1, 0)])
    assert f.closed() == {}
    f.take([_record("t1", 1, 4, 9)], [_mark("t2", 1), _mark("t3", 0)])
    assert f.closed() == {"t1": (2, 1, 0, 2), "t2": (1, 1, 0, 3), "t3": (0, 0, 0, 3)}
    want = [("t1", 1, 4, "a.sac", 9), ("t1", 2, 0, "a.sac", 3), ("t2", 1, 0, "a.sac", 0)]
    assert f.index() == want
    # late and nameless rows are refused, and a timestamp that has more than was promised says so
    f.take([_record("t1", 1, 4, 0), _record("t1", 7, 7), _mark("t1", 50), _record(None, 1, 1), _mark("t4", 1), _record("t4", 1, 1), _record("t4", 1, 2)])
    assert f.index() == [*want, ("t4", 1, 1, "a.sac", 0), ("t4", 1, 2, "a.sac", 0)] and f.closed()["t4"] == (2, 0, 1, 4)
    assert indexes.refused(spark, f.folder).count() == 4
    assert indexes.finish(spark, f.folder) == {"timestamps": 4, "records": 5, "repeated": 2, "surplus": 1, "refused": 4}
    assert store.exists(spark, f"{f.folder}/_SUCCESS")


def test_a_batch_that_runs_again_changes_nothing(spark, tmp_path):
    f = Feed(spark, tmp_path)
    f.take([_record("t1", 1, 0)], [_mark("t1", 1), _record("t2", 1, 0)], [_mark("t2", 2)], [_record("t2", 1, 1)])
    before, closed = f.index(), f.closed()
    again = indexes._batch(f.folder, 16)
    pending = lambda k: spark.createDataFrame(spark.read.schema(indexes.SCHEMA).parquet(f"{f.folder}/pending/batch={k}").collect(), indexes.SCHEMA)
    for k in (3, 1):
        again(pending(k), k)
    assert f.index() == before and f.closed() == closed
    # a batch that stopped before its last table: its index does not count until it has run again
    store.remove(spark, f"{f.folder}/closed/built=3")
    assert [r[0] for r in f.index()] == ["t1"]
    again(pending(3), 3)
    assert f.index() == before and f.closed() == closed


def test_pending_rows_of_closed_timestamps_are_removed(spark, tmp_path):
    f = Feed(spark, tmp_path)
    f.take([_record("t1", 1, 0), _mark("t1", 1)], [_record("t2", 1, 0)], [_record("t3", 1, 0), _mark("t3", 1)], [_mark("t4", 1)], tidy_every=4)
    assert store.folders(spark, f"{f.folder}/pending") == ["batch=1", "batch=3"]
    f.take([_mark("t2", 1)], [_record("t4", 1, 0)])
    assert [r[0] for r in f.index()] == ["t1", "t2", "t3", "t4"]
