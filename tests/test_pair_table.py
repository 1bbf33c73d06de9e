import json

import numpy as np
import pytest

from noisefield.plans import config
from noisefield.plans.run import Run
from noisefield.sources import sac, tables

LINES = [
    "path_id\tsrc\trec\tsg\trg\tdeg\tkm\taz\tbaz",
    "# a comment",
    "",
    "   ",
    "10002\t1\t2\tg\tg\t1.5\t166.8\t10\t190\r",
    "10003\t1\t3\t\tg\tg\t222.39\t20\t200",  # eight fields; two tabs count as one
    "20001\t2\t1\tg\tg\t1.5\t166.8\t10\t190",  # swapped
    "20002\t2\t3\tg\tg\t1\t2\t3\t4",  # another id
    "0\t0\t0\tg\tg\t1\t2\t3\t4",
    "-1\t1\t2\tg\tg\t1\t2\t3\t4",
    "abc\t1\t2\tg\tg\t1\t2\t3\t4",
    "20003\t2\t3\tg\tg\tnone\t2\t3\t4",
    "20003\t2\t3\tg\tg\t1\t2",
    "10002\t1\t2\tg\tg\t1.4\t160\t10\t190",  # once more
    "30003\t3\t3\tg\tg\t0\t0\t0\t0\tmore\tfields",
    "23456\t2\t3456\tg\tg\t1\t2\t3\t4",
    "20010000\t2000\t10000\tg\tg\t1\t2\t3\t4",  # a number that does not fit below the base
]


def test_lines_and_faults(spark, tmp_path):
    (tmp_path / "pairs.tsv").write_text("\n".join(LINES))
    parsed = tables.pair_file(spark, str(tmp_path / "pairs.tsv"))
    got = {r.path_id: tuple(r)[5:] for r in tables.allowed_pairs(parsed).collect()}
    assert got == {10002: (1.4, 160.0, 10.0, 190.0), 10003: (pytest.approx(2.0), 222.39, 20.0, 200.0), 23456: (1.0, 2.0, 3.0, 4.0), 30003: (0.0,) * 4}
    assert {r.fault: r.lines for r in tables.pair_faults(parsed).collect()} == {"short": 1, "malformed": 2, "not_canonical": 5}
    assert tables.allowed_pairs(parsed.where("false")).count() == 0 and {r.lines for r in tables.pair_faults(parsed.where("false")).collect()} == {0}


def test_lookup_in_either_order(spark, tmp_path):
    (tmp_path / "pairs.tsv").write_text("\n".join(LINES))
    allowed = tables.allowed_pairs(tables.pair_file(spark, str(tmp_path / "pairs.tsv")))
    asked = spark.createDataFrame([(1, 2), (2, 1), (3, 3), (2, 3), (None, 1)], "a int, b int")
    found = tables.find_pairs(asked, allowed, "a", "b")
    assert {(r.a, r.b, r.path_id, r.reversed, r.distance_km) for r in found.collect()} == {(1, 2, 10002, False, 160.0), (2, 1, 10002, True, 160.0), (3, 3, 30003, False, 0.0)}
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_a_given_table_drives_a_run(spark, tmp_path):
    rng = np.random.default_rng(2)
    root = tmp_path / "data"
    for k, station in enumerate(("AA", "BB", "CC")):
        path = root / "2022" / f"{station}.137.BHZ.sac"
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_bytes(sac.encode({"delta": 1.0, "stla": 10.0 + k, "stlo": 20.0, "kstnm": station, "data": rng.normal(size=200)}))
    lines = ["10003\t1\t3\tg\tg\t3.5\t389.1\t12\t192", "30002\t3\t2\tg\tg\t1\t2\t3\t4", "10007\t1\t7\tg\tg\t1\t2\t3\t4", "short\tline"]
    (tmp_path / "pairs.tsv").write_text("\n".join(lines))
    c = config.RunConfig(
        sources=[config.Source(str(root), "{home}/{YYYY}/{station}.{JJJ}.{channel}.sac", components=("BHZ",))], pair_table=str(tmp_path / "pairs.tsv"),
        record_seconds=200, window_seconds=100, delta=1.0, max_lag_seconds=10, whiten="OFF", normalize="OFF", output=str(tmp_path / "out"),
    )
    config.dump(c, str(tmp_path / "c.ini"))
    assert config.load(str(tmp_path / "c.ini")) == c
    run = Run(spark, c)
    run.go(["prepare", "spectra", "correlate", "stack"])
    pair = run.table("pairs").collect()
    assert [(r.path_id, r.src_id, r.rec_id, r.distance_km, r.azimuth_deg) for r in pair] == [(10003, 1, 3, 389.1, 12.0)]
    assert {r.station for r in run.table("channels").collect()} == {"AA", "CC"}
    assert {r.path_id for r in run.table("stack_linear").collect()} == {10003}
    facts = json.loads(spark.read.text(run.path("inventory.json")).first()[0])
    assert (facts["pair_lines"], facts["pair_lines_short"], facts["pair_lines_malformed"], facts["pair_lines_not_canonical"], facts["pairs"]) == (4, 1, 0, 1, 1)
