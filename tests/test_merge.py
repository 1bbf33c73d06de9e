import datetime

import numpy as np
import pytest
from pyspark.sql import functions as F

from noisefield.operators import merge, stack
from noisefield.plans import config
from noisefield.plans.run import Run
from noisefield.sources import sac

SCHEMA = "path_id long, slot int, timestamp timestamp, record_path string, record_offset long, delta double, head string, data array<double>"


def _rows(days, pairs=(10002, 10003), delta=1.0, width=5, name="a"):
    return [(p, s, datetime.datetime(2022, 1, d), f"{name}{d}.sac", 100 * s, delta, f'{{"day":{d}}}', [float(p + s + d * k) for k in range(width)]) for d in days for p in pairs for s in (0, 8)]


def _table(spark, base, name, *runs):
    return merge.bucket_records([spark.createDataFrame(rows, SCHEMA) for rows in runs], name, str(base / name), 4)


def test_runs_are_stacked_without_an_exchange(spark, tmp_path):
    whole = _table(spark, tmp_path, "merge_a", _rows((5, 3)), _rows((1, 2, 9), (10003, 20003), name="b"))
    merge.bucket_records([spark.createDataFrame(_rows((4,))[:1], SCHEMA)], "merge_a", str(tmp_path / "merge_a"), 4, append=True)
    whole = spark.table("merge_a")
    got = merge.merged_stack(whole)
    for adaptive in ("true", "false"):
        spark.conf.set("spark.sql.adaptive.enabled", adaptive)
        plan = got._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" not in plan and "Bucketed: true" in plan
        rows = {(r.path_id, r.slot): r for r in merge.merged_stack(whole).collect()}
        want = {(r.path_id, r.slot): (r.n, r.data) for r in stack.linear_stack(spark.createDataFrame(whole.collect(), SCHEMA), 5).collect()}
        assert {k: (r.n, r.data) for k, r in rows.items()} == {k: (n, pytest.approx(x)) for k, (n, x) in want.items()} and len(rows) == 6
        assert {k: (r.first_timestamp.day, r.head) for k, r in rows.items() if k[1] == 0} == {(10002, 0): (3, '{"day":3}'), (10003, 0): (1, '{"day":1}'), (20003, 0): (1, '{"day":1}')}
    spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert merge.merged_stack(whole.where("false")).count() == 0


@pytest.mark.parametrize("bad", [{"delta": 1.001}, {"width": 6}, {"delta": None}])
def test_records_that_do_not_fit_are_named(spark, tmp_path, bad):
    with pytest.raises(Exception, match=r"(odd7|a[12])\.sac: . numbers"):
        merge.merged_stack(_table(spark, tmp_path, "merge_d", _rows((1, 2)), _rows((7,), **{"name": "odd", **bad}))).collect()
    assert merge.merged_stack(_table(spark, tmp_path, "merge_f", _rows((1, 2)), _rows((7,), delta=1.0 + 1e-8))).count() == 4


def test_a_run_stacks_the_packs_of_another(spark, tmp_path):
    rng = np.random.default_rng(3)
    for day in (137, 138):
        for station in ("AA", "BB", "CC"):
            x = rng.normal(size=200)
            for where in (f"day{day}", "both"):
                path = tmp_path / where / "2022" / f"{station}.{day}.BHZ.sac"
                path.parent.mkdir(parents=True, exist_ok=True)
                path.write_bytes(sac.encode({"delta": 1.0, "stla": 10.0 + ord(station[0]) / 10, "stlo": 20.0, "kstnm": station, "data": x}))

    def run(where, **kw):
        c = config.RunConfig(
            sources=[config.Source(str(tmp_path / where), "{home}/{YYYY}/{station}.{JJJ}.{channel}.sac", components=("BHZ",))], stack_flag="110", pre_stack_size=1, buckets=3,
            record_seconds=200, window_seconds=100, delta=1.0, max_lag_seconds=10, whiten="OFF", normalize="OFF", output=str(tmp_path / f"out-{where}"), **kw,
        )
        config.dump(c, str(tmp_path / "c.ini"))
        assert config.load(str(tmp_path / "c.ini")) == c
        made = Run(spark, c)
        made.go(skip=["rotate", "unpack"])
        return made

    first = run("day137", pack=True)
    whole = run("both")
    second = run("day138", other_indexes=(f"{first.path('packs')}/record_index.tsv",))
    for m in ("linear", "pws"):
        want = {(r.path_id, r.slot): (r.n, r.data) for r in whole.table(f"stack_{m}").collect()}
        got = {(r.path_id, r.slot): (r.n, r.data) for r in second.table(f"stack_{m}").collect()}
        assert got == {k: (n, pytest.approx(x, abs=1e-4)) for k, (n, x) in want.items()} and len(got) == 3
    one = second.table("stack_linear").where("path_id = 10002").select(F.from_json("head", "delta float, b float").alias("h"), "first_timestamp").first()
    assert (one.h.delta, one.h.b, one.first_timestamp.timetuple().tm_yday) == (1.0, -10.0, 137)

    # the verbs that read what a run left
    from noisefield.__main__ import main

    index = f"{first.path('packs')}/record_index.tsv"
    assert main(["extract", index, "AA", "CC", "Z-Z", str(tmp_path / "one"), "--timestamp", "2022.137.0000"]) == 0
    record = sac.read(spark, str(tmp_path / "one")).first()
    assert record.data == pytest.approx(first.table("ncf").where("path_id = 10003").first().data, rel=1e-5, abs=1e-5)
    assert main(["extract", index, "CC", "AA", "Z/Z", str(tmp_path / "turned"), "--reverse"]) == 0
    assert main(["extract", first.path("record_lookup"), "AA", "CC", "Z-Z", str(tmp_path / "found"), "--timestamp", "2022.137.0000"]) == 0
    assert sac.read(spark, str(tmp_path / "found")).first().data == record.data
    with pytest.raises(LookupError, match="no record matches"):
        main(["extract", index, "CC", "AA", "Z/Z", str(tmp_path / "turned")])
    config.dump(second.config, str(tmp_path / "c.ini"))
    assert main(["dat", str(tmp_path / "c.ini"), "stack_linear", str(tmp_path / "dat"), "--receivers", "CC"]) == 0
    assert len(list((tmp_path / "dat").rglob("*.dat"))) == 2
    with pytest.raises(ValueError, match="no traces of XX"):
        main(["dat", str(tmp_path / "c.ini"), "stack_linear", str(tmp_path / "dat"), "--receivers", "XX"])
