import datetime

import numpy as np
import pytest
from pyspark.sql import functions as F

from noisefield.operators import inventory
from noisefield.sources import pack, sac, store

PATTERN = "{home}/{YYYY}/{network}.{station}.{JJJ}.{channel}.sac"


def _put(root, station, day, component, value=1.0, network="NN"):
    path = root / "2022" / f"{network}.{station}.{day:03}.{component}.sac"
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_bytes(sac.encode({"delta": 1.0, "kstnm": station, "data": [value] * 5}))
    return path


@pytest.fixture()
def folder(spark, tmp_path):
    sac.register(spark)
    root = tmp_path / "data"
    for station in ("AA", "BB"):
        for day in (1, 2):
            for component in ("BHE", "BHZ"):
                _put(root, station, day, component, day)
    (root / "2022" / "notes.txt").write_text("not a record")
    return root


def _read(spark, root):
    return spark.read.format("sac").option("pattern", PATTERN).load(str(root))


def test_path_fields_and_filters_open_only_what_they_need(spark, folder):
    rows = _read(spark, folder).collect()
    assert len(rows) == 8 and {(r.network, r.station, r.location, r.component, r.time) for r in rows} == {("NN", s, "00", c, datetime.datetime(2022, 1, d)) for s in ("AA", "BB") for c in ("BHE", "BHZ") for d in (1, 2)}
    # files that cannot be read are errors where they are opened, and only there
    for path in (folder / "2022").glob("NN.BB.*"):
        path.write_bytes(b"damaged")
    (folder / "2022" / "NN.AA.002.BHZ.sac").write_bytes(b"damaged")
    with pytest.raises(Exception, match="632 bytes"):
        _read(spark, folder).collect()
    kept = _read(spark, folder).where("station = 'AA' and time < '2022-01-02'")
    assert sorted(r.component for r in kept.collect()) == ["BHE", "BHZ"]
    assert _read(spark, folder).where(F.col("component").isin("BHE", "BHN") & F.col("station").startswith("A")).count() == 2
    assert _read(spark, folder).where("station = 'AA' and component = 'BHE' and kstnm = 'BB'").count() == 0
    assert _read(spark, folder).where("station = 'CC'").count() == 0


def test_paths_read_in_python_as_in_columns(spark):
    for pattern in (PATTERN, "{home}/{station}/{?}/{YYYY}{JJJ}.{station}.{*}.{component}", "{home}/{YY}{MM}{DD}T{HH}{MI}.{station}.{component}"):
        p = inventory.PathPattern(pattern, "/d")
        paths = ["/d/2022/NN.AA.001.BHZ.sac", "/d/2022/NN.AA.400.BHZ.sac", "/d/AB1/x/2022137.AB1.q.w.BHZ", "/d/AB1/x/2022137.AB2.q.BHZ", "/d/220230T1200.S.Z", "/d/220228T2500.S.Z", "/d/220228T2359.S.Z", "/e/x", ""]
        names = ["network", "station", "location", "component", "time"]
        want = {r.path: tuple(r[c] for c in names) for r in p.match(spark.createDataFrame([(x,) for x in paths], "path string")).collect()}
        assert {x: tuple(got[c] for c in names) for x in paths if (got := p.read(x))} == want


def test_a_stream_takes_in_each_file_once(spark, folder, tmp_path):
    def run():
        rows = spark.readStream.format("sac").option("pattern", PATTERN).option("log", str(tmp_path / "log")).load(str(folder)).select("station", "component", "time", F.element_at("data", 1).alias("v"))
        rows.writeStream.format("parquet").option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "progress")).trigger(availableNow=True).start().awaitTermination()
        return sorted((r.station, r.component, r.time.day, r.v) for r in spark.read.parquet(str(tmp_path / "out")).collect())

    first = run()
    assert len(first) == 8
    assert run() == first
    # a new file counts even where its time is old; one that was taken in does not count again
    import os

    late = _put(folder, "CC", 5, "BHZ", 7.0)
    os.utime(late, (1, 1))
    _put(folder, "AA", 1, "BHZ", 99.0)
    assert run() == sorted([*first, ("CC", "BHZ", 5, 7.0)])
    with pytest.raises(Exception, match="option log"):
        spark.readStream.format("sac").load(str(folder)).writeStream.format("noop").option("checkpointLocation", str(tmp_path / "p2")).trigger(availableNow=True).start().awaitTermination()


@pytest.fixture()
def records(spark):
    rows = [(t, 10002 + p, s, 1.0, f"S{p}", [float(t + p + s + k) for k in range(3 + p)]) for t in range(4) for p in range(3) for s in range(2)]
    return spark.createDataFrame(rows, "timestamp long, path_id long, slot int, delta float, kstnm string, data array<float>")


def test_packs_are_read_back_by_their_index(spark, records, tmp_path):
    sac.register(spark)
    folder = str(tmp_path / "packs")
    order = ["timestamp", "path_id", "slot"]
    records.repartition(2, "timestamp").sortWithinPartitions(*order).write.format("sacpack").option("roll_bytes", 3000).mode("append").save(folder)
    index = pack.pack_index(spark, folder)
    assert index.count() == 24 and index.select("record_path").distinct().count() > 4
    assert max(r.z for r in index.groupBy("record_path").agg((F.max(F.col("record_offset") + F.col("bytes"))).alias("z")).collect()) <= 3000
    want = {(r.timestamp, r.path_id, r.slot): (r.kstnm, r.data) for r in records.collect()}
    assert {(r.timestamp, r.path_id, r.slot): (r.kstnm, r.data) for r in pack.read_pack(index).collect()} == want
    some = pack.read_pack(index.where("timestamp = 2 and path_id = 10003")).collect()
    assert {(r.timestamp, r.path_id, r.slot): (r.kstnm, r.data) for r in some} == {k: v for k, v in want.items() if k[:2] == (2, 10003)}
    # inside a file, records stand in the order of time and pair
    for path in {r.record_path for r in index.collect()}:
        held = [(r.timestamp, r.path_id, r.slot) for r in index.where(F.col("record_path") == path).orderBy("record_offset").collect()]
        assert held == sorted(held)
    records.where("timestamp = 3").withColumn("timestamp", F.lit(9).cast("long")).write.format("sacpack").mode("append").save(folder)
    assert pack.pack_index(spark, folder).count() == 30
    records.where("timestamp = 1").coalesce(1).write.format("sacpack").mode("overwrite").save(folder)
    assert {r.timestamp for r in pack.read_pack(pack.pack_index(spark, folder)).collect()} == {1}
    assert len(store.listed(folder, ".sac")) == 1 and not [x for x in store.folders(spark, folder)]


def test_a_job_that_fails_leaves_nothing_visible(spark, records, tmp_path):
    sac.register(spark)
    folder = str(tmp_path / "packs")
    records.where("timestamp = 0").write.format("sacpack").mode("append").save(folder)
    before = {tuple(r) for r in pack.pack_index(spark, folder).collect()}
    bad = records.repartition(4).withColumn("data", F.when(F.col("path_id") == 10004, F.array(F.lit("x").cast("string")).cast("array<float>")).otherwise(F.col("data"))).withColumn("data", F.when(F.assert_true(F.col("path_id") != 10004).isNull(), F.col("data")))
    for mode in ("append", "overwrite"):
        with pytest.raises(Exception):
            bad.write.format("sacpack").mode(mode).save(folder)
        assert {tuple(r) for r in pack.pack_index(spark, folder).collect()} == before
        assert store.folders(spark, folder) == []
    # a task that was left behind after a commit is not seen either
    w = pack.PackWriter({"path": folder}, records.columns, False)
    w.write(iter(records.where("timestamp = 1")._collect_as_arrow()))
    assert {tuple(r) for r in pack.pack_index(spark, folder).collect()} == before
    with pytest.raises(FileNotFoundError, match="no records have been committed"):
        pack.pack_index(spark, str(tmp_path / "none"))
    with pytest.raises(Exception, match="needs the columns slot"):
        records.drop("slot").write.format("sacpack").mode("append").save(folder)


def test_empty_packs(spark, records, tmp_path):
    sac.register(spark)
    records.where("false").write.format("sacpack").mode("append").save(str(tmp_path / "packs"))
    with pytest.raises(FileNotFoundError):
        pack.pack_index(spark, str(tmp_path / "packs"))


def test_windows_by_mark_read_only_their_bytes(spark, tmp_path):
    x = np.arange(1, 101, dtype=float)
    heads = {"plain": {"delta": 0.5, "b": 10.0, "t3": 20.0, "a": 12.25, "o": -40.0}, "none": {"delta": 0.5, "b": 10.0}}
    for name, head in heads.items():
        (tmp_path / f"{name}.sac").write_bytes(b"pad." * 3 + sac.encode({**head, "data": x}))
    places = spark.createDataFrame([(str(tmp_path / "plain.sac"), 12, "k")], "path string, at long, key string")

    def window(*a):
        return sac.read_windows(places, *a, offset_col="at", carry=("key",)).first()

    for mark, zero in (("t3", 20.0), ("a", 12.25), ("b", 10.0), ("o", -40.0), ("absolute", 0.0)):
        for first, last in ((0.0, 5.0), (-30.0, 3.2), (30.0, 60.0), (500.0, 503.0), (1.0, 1.0), (-1e3, 1e3)):
            r = window(mark, first, last)
            start, n = round((zero + first - 10.0) / 0.5), round((last - first) / 0.5)
            want = [float(x[k]) if 0 <= k < 100 else 0.0 for k in range(start, start + n)]
            assert (r.data, r.npts, r.b, r.key) == (want, n, 10.0 + start * 0.5, "k") and r.bytes_read == 632 + 4 * sum(v > 0 for v in want)
    bare = spark.createDataFrame([(str(tmp_path / "none.sac"), 12)], "path string, at long")
    with pytest.raises(Exception, match="no t3"):
        sac.read_windows(bare, "t3", 0, 1, offset_col="at").collect()
    for bad in (("t10", 0, 1), ("a", 2, 1)):
        with pytest.raises(ValueError, match="a window counts from"):
            sac.read_windows(bare, *bad)
    (tmp_path / "whole.sac").write_bytes(sac.encode({**heads["plain"], "data": x}))
    whole = sac.read(spark, str(tmp_path / "whole.sac")).first()
    assert (whole.t3, whole.a, whole.o, whole.t0) == (20.0, 12.25, -40.0, None)
