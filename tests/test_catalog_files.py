from noisefield.plans import config
from noisefield.plans.run import Run
from noisefield.sources import sac


def test_a_run_writes_its_catalog_and_another_runs_from_it(spark, tmp_path):
    root = tmp_path / "data"
    for day in (137, 138):
        for k, station in enumerate(("BB", "AA", "CC")):
            for comp in ("X", "Z", "E"):
                path = root / "2022" / f"{station}.{day}.{comp}.sac"
                path.parent.mkdir(parents=True, exist_ok=True)
                path.write_bytes(sac.encode({"delta": 1.0, "stla": 10.0 + k, "stlo": 20.0 + k, "kstnm": station, "data": [0.0] * 100}))

    def run(where, **kw):
        c = config.RunConfig(sources=[config.Source(str(root), "{home}/{YYYY}/{station}.{JJJ}.{channel}.sac", components=("X", "Z", "E"))], record_seconds=100, window_seconds=50, max_lag_seconds=10, output=str(tmp_path / where), **kw)
        config.dump(c, str(tmp_path / "c.ini"))
        assert config.load(str(tmp_path / "c.ini")) == c
        made = Run(spark, c)
        made.prepare()
        return made

    lines = lambda folder: [x for f in sorted(folder.glob("part-*")) for x in f.read_text().splitlines()]
    first = run("first", text_tables=True, distance_km=(-1.0, 200.0))
    run("first", text_tables=True, distance_km=(-1.0, 200.0))  # again, over what is there
    catalog = tmp_path / "first" / "catalog"
    want = {(r.path_id, r.src_id, r.rec_id) for r in first.table("pairs").collect()}
    assert len(want) == 2
    assert lines(catalog / "pair_ids.txt") == [f"{k:08d}" for k, _, _ in sorted(want)]
    assert [x.split("\t")[:3] for x in lines(catalog / "pairs.tsv") if x[0] != "p"] == [[f"{a:08d}", f"{b:04d}", f"{c:04d}"] for a, b, c in sorted(want)]
    assert [x.split("\t")[0] for x in lines(catalog / "stations.tsv")] == ["nsl_id", "0001", "0002", "0003"]
    assert [x for x in lines(catalog / "timestamps.tsv") if x[0] != "t"] == ["2022.137.0000\t9", "2022.138.0000\t9"]
    day = [x.split("\t") for x in lines(catalog / "manifests.tsv" / "timestamp=2022.138.0000")]
    assert day[0] == ["nsl_id", "group", "network", "station", "location", "component", "path"]
    order = {"E": 0, "N": 1, "Z": 2}
    assert len(day) == 10 and day[1:] == sorted(day[1:], key=lambda r: (r[0], order.get(r[5], 98), r[5], r[6]))

    second = run("second", pair_table=str(catalog / "pairs.tsv"))
    assert {(r.path_id, r.src_id, r.rec_id) for r in second.table("pairs").collect()} == want
