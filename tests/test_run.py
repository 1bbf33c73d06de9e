import numpy as np
import pytest

from noisefield.plans import config
from noisefield.plans.run import Run, chosen_stages
from noisefield.sources import sac, tables


def test_sac_round_trip_and_byte_order():
    fields = {"delta": 0.5, "stla": 10.5, "kstnm": "ABC", "kevnm": "NN.SOURCE", "nzyear": 2022, "data": [1.0, 2.0, 3.0]}
    raw = sac.encode(fields)
    assert len(raw) == 632 + 12
    got = sac.decode(raw)
    assert (got["npts"], got["delta"], got["stla"], got["kstnm"], got["kevnm"], got["nzyear"], got["stlo"]) == (3, 0.5, 10.5, "ABC", "NN.SOURCE", 2022, None)
    assert got["data"].tolist() == [1, 2, 3]
    swapped = np.frombuffer(raw[:440], "<u4").byteswap().tobytes() + raw[440:632] + np.frombuffer(raw[632:], "<u4").byteswap().tobytes()
    assert sac.decode(swapped)["data"].tolist() == [1, 2, 3]
    with pytest.raises(ValueError):
        sac.decode(raw[:-4])


def test_config_checks_and_round_trip(tmp_path):
    c = config.RunConfig(sources=[config.Source("/d", "{home}/{YYYY}/{JJJ}.{station}.{component}", components=("E", "N", "Z"))], bands=((0.1, 0.2),), skip_steps=(1, 3), tf_band=(0.1, 0.3))
    config.dump(c, str(tmp_path / "c.ini"))
    assert config.load(str(tmp_path / "c.ini")) == c
    (tmp_path / "bad.ini").write_text("[spectra]\nwindw_seconds = 3\n")
    with pytest.raises(ValueError, match="window_seconds"):
        config.load(str(tmp_path / "bad.ini"))
    for bad in ({"bands": ((0.1, 0.9),)}, {"whiten": "SOME"}, {"stack_flag": "12"}, {"distance_km": (5, 1)}, {"delta": 0}):
        with pytest.raises(ValueError):
            config.RunConfig(**bad)
    assert chosen_stages(skip=["unpack"]) == ["prepare", "spectra", "correlate", "pack", "stack", "rotate"]
    with pytest.raises(ValueError, match="spectra"):
        chosen_stages(only=["spectr"])


def test_tables(spark, tmp_path):
    (tmp_path / "geo.tsv").write_text("station\tlatitude\tlon\nA\t1.5\t2.5\nB\t3\t4\n")
    assert {(r.station, r.lat, r.lon) for r in tables.station_coordinates(spark, str(tmp_path / "geo.tsv")).collect()} == {("A", 1.5, 2.5), ("B", 3.0, 4.0)}
    (tmp_path / "twice.tsv").write_text("station\tlat\tlon\nA\t1\t2\nA\t3\t4\n")
    with pytest.raises(ValueError):
        tables.station_coordinates(spark, str(tmp_path / "twice.tsv"))
    (tmp_path / "list.txt").write_text("# stations\nA\n\n B \n")
    assert {r.station for r in tables.listed(spark, str(tmp_path / "list.txt")).collect()} == {"A", "B"}


def test_whole_run(spark, tmp_path):
    rng = np.random.default_rng(1)
    root = tmp_path / "data"
    for day in (137, 138):
        common = rng.normal(size=420)
        for k, station in enumerate(("AA", "BB", "CC")):
            for comp in ("BHE", "BHN", "BHZ"):
                x = np.roll(common, 5 * k)[:400] + 0.05 * rng.normal(size=400)
                path = root / "2022" / f"{station}.{day}.{comp}.sac"
                path.parent.mkdir(parents=True, exist_ok=True)
                path.write_bytes(sac.encode({"delta": 1.0, "stla": 10.0 + k, "stlo": 20.0 + k, "kstnm": station, "data": x}))
    c = config.RunConfig(
        sources=[config.Source(str(root), "{home}/{YYYY}/{station}.{JJJ}.{channel}.sac", components=("BHE", "BHN", "BHZ"))],
        record_seconds=400, window_seconds=100, delta=1.0, bands=((0.05, 0.4),), max_lag_seconds=20, stack_flag="111", pre_stack_size=1, whiten="OFF", output=str(tmp_path / "out"),
    )
    run = Run(spark, c)
    assert run.go() == ["prepare", "spectra", "correlate", "stack", "rotate", "unpack"]
    assert run.table("channels").count() == 18 and run.table("pairs").count() == 3
    for m in ("linear", "pws", "tfpws"):
        rows = {(r.path_id, r.slot): np.array(r.data) for r in run.table(f"stack_{m}").collect()}
        assert len(rows) == 27
        assert int(rows[10002, 0].argmax()) - 20 == 5 and int(rows[10003, 8].argmax()) - 20 == 10
    assert run.table("rotated_linear").count() == 27
    assert run.table("written").count() == 27 * 3 * 2
    spark_rows = sac.read(spark, str(tmp_path / "out" / "sac" / "stack_linear"))
    assert spark_rows.count() == 27 and {r.kcmpnm for r in spark_rows.select("kcmpnm").collect()} >= {"E-E", "Z-Z"}
    head = spark_rows.where("kcmpnm = 'Z-Z'").first()
    assert (head.user0, head.depmax) == (2, pytest.approx(max(head.data))) and head.depmin <= head.depmen <= head.depmax and head.kuser0 is None
    pws = sac.read(spark, str(tmp_path / "out" / "sac" / "stack_pws")).first()
    assert (pws.user0, pws.user1, pws.user2, pws.kuser0, pws.kuser1, pws.kuser2) == (2, 2, 1, "NTRACE", "NGROUP", "SUBSTK")
    turned = sac.read(spark, str(tmp_path / "out" / "sac" / "rotated_linear")).first()
    assert turned.cmpinc == 90 and turned.cmpaz == pytest.approx((turned.baz + 180) % 360, abs=1e-3) and turned.user2 == 10000 * turned.user0 + turned.user1
    import json

    facts = json.loads(spark.read.text(run.path("inventory.json")).first()[0])
    assert (facts["stations"], facts["pairs"], facts["channels"], facts["timestamps"], facts["stations_without_coordinates"]) == (3, 3, 18, 2, 0)
    dats = sac.write_dat(run.records("stack_linear", "ENZ"), str(tmp_path / "dat"), 20).collect()
    text = (tmp_path / "dat" / dats[0].name).read_text().splitlines()
    assert len(dats) == 27 and dats[0].lines == len(text) == 2 + 21 and len(text[0].split()) == len(text[5].split()) == 3
    sac.register(spark)
    assert spark.read.format("sac").load(str(tmp_path / "out" / "sac" / "stack_linear")).count() == 27


def test_packed_records_are_read_by_place(spark, tmp_path):
    raws = [sac.encode({"delta": 1.0, "kstnm": f"S{k}", "stla": float(k), "stlo": 1.0, "data": np.arange(k + 1.0)}) for k in range(4)]
    at = np.cumsum([0, *map(len, raws)])
    path = str(tmp_path / "pack.sac")
    (tmp_path / "pack.sac").write_bytes(b"".join(raws))
    places = spark.createDataFrame([(path, int(at[k]), len(raws[k])) for k in (3, 0, 2)] + [("file://" + path, int(at[1]), None)], "path string, offset long, bytes long")
    got = {r.record_offset: r for r in sac.read_records(places, "path", "offset", "bytes").collect()}
    assert {k: (got[at[k]].kstnm, len(got[at[k]].data)) for k in range(4)} == {k: (f"S{k}", k + 1) for k in range(4)}
    assert {(r.kstnm, r.stla) for r in sac.station_geometry(places.select("path").distinct()).collect()} == {("S0", 0.0)}
    for bad in ((path, int(at[1]), 5), (path, int(at[4]), None), (path, -1, None)):
        with pytest.raises(Exception, match="bytes|offset"):
            sac.read_records(spark.createDataFrame([bad], "path string, offset long, bytes long"), "path", "offset", "bytes").collect()
    with pytest.raises(Exception, match="no task can open this store"):
        sac.read_records(spark.createDataFrame([("nowhere://x/y",)], "path string")).collect()


def test_record_indexes(spark, tmp_path):
    row = {c: "x" for c in tables.INDEX_COLUMNS} | {c: "1" for c in tables._NUMBERS}
    lines = lambda *rows: "\n".join("\t".join(r[c] for c in tables.INDEX_COLUMNS) for r in ({c: c for c in tables.INDEX_COLUMNS}, *rows)) + "\n"
    for name, rows in (("a", [row]), ("b", [row, row | {"bytes": "many"}, row | {"record_offset": "-4"}])):
        (tmp_path / name).mkdir()
        (tmp_path / name / "record_index.tsv").write_text(lines(*rows))
    (tmp_path / "list.txt").write_text("# indexes\na/record_index.tsv\n")
    found = tables.found_indexes(spark, str(tmp_path))
    assert [x.split("/")[-2] for x in found] == ["a", "b"] and tables.found_indexes(spark, str(tmp_path / "a")) == found[:1] == tables.found_indexes(spark, str(tmp_path / "list.txt"))
    assert tables.record_index(spark, found[0]).first().path_id == 1 and tables.record_index(spark, found, strict=False).count() == 2
    with pytest.raises(Exception, match="cannot be read"):
        tables.record_index(spark, found).collect()
    with pytest.raises(FileNotFoundError):
        (tmp_path / "c").mkdir()
        tables.found_indexes(spark, str(tmp_path / "c"))
    tables.write_tsv(tables.record_index(spark, found[0]), str(tmp_path / "out"))
    assert tables.record_index(spark, str(tmp_path / "out")).count() == 1
    tables.write_by_time(spark.createDataFrame([("t1", 2), ("t1", 1), ("t2", 3)], "timestamp string, k int"), str(tmp_path / "times"), "k")
    assert spark.read.parquet(str(tmp_path / "times" / "timestamp=t1")).count() == 2


def test_steps_to_skip(spark):
    from noisefield.operators import correlate

    c = config.RunConfig(record_seconds=400, window_seconds=100, delta=1.0, skip_steps=(0, 1, 2, 3))
    assert c.steps() == 4
    with pytest.raises(ValueError, match="none of the 4 steps"):
        c.check_skipped_steps()
    with pytest.warns(UserWarning, match="names 7"):
        config.RunConfig(record_seconds=400, window_seconds=100, delta=1.0, skip_steps=(0, 7)).check_skipped_steps()
    df = spark.createDataFrame([(1, 1, "Z", [float(k % 7) for k in range(60)]), (1, 1, "N", [float(k % 5) for k in range(40)])], "timestamp int, nsl_id int, component string, data array<double>")
    made = correlate.spectra(df, correlate.Conditioning(1.0, 20, 10, 5, normalize="OFF", whiten="OFF", skip_steps=(1,))).collect()
    assert sorted((r.component, r.step) for r in made) == [("N", 0), ("N", 2), ("Z", 0), ("Z", 2), ("Z", 3), ("Z", 4)]
    with pytest.raises(Exception, match="none of the 2 steps"):
        correlate.spectra(df.where("component = 'N'"), correlate.Conditioning(1.0, 20, 20, 5, normalize="OFF", whiten="OFF", skip_steps=(0, 1))).collect()


def test_command_line(tmp_path, capsys):
    from noisefield.__main__ import main

    assert main(["init", str(tmp_path / "c.ini")]) == 0 and main(["check", str(tmp_path / "c.ini")]) == 0
    assert "1 sources" in capsys.readouterr().out
