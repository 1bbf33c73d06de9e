import json
import math

import numpy as np
import pytest
from pyspark.sql import Observation, functions as F

from noisefield.operators import rotate
from noisefield.plans import config
from noisefield.plans.run import Run
from noisefield.sources import sac

HEAD = ("delta", "evla", "evlo", "stla", "stlo", "gcarc", "dist", "az", "baz")
SCHEMA = "pair string, slot int, data array<double>, " + ", ".join(f"{c} double" for c in HEAD)
PLACE = {"delta": 0.5, "evla": 10.0, "evlo": 20.0, "stla": 12.0, "stlo": 25.0}


def _pair(name, slots=range(9), width=4, **head):
    return [(name, k, [float(k * 10 + j) for j in range(width)], *(head.get(c) for c in HEAD)) for k in slots]


def _rotated(x, az, baz):
    az, baz = math.radians(az), math.radians(baz)
    src = np.array([[math.sin(az), math.cos(az), 0], [math.cos(az), -math.sin(az), 0], [0, 0, 1]])
    rec = np.array([[-math.sin(baz), -math.cos(baz), 0], [-math.cos(baz), math.sin(baz), 0], [0, 0, 1]])
    return np.einsum("ai,bj,ijt->abt", src, rec, x.reshape(3, 3, -1)).reshape(9, -1)


def test_geometry_comes_from_coordinates_or_from_the_header(spark):
    own = {"delta": 0.5, "gcarc": 1.0, "dist": 111.0, "az": 30.0, "baz": 215.0}
    rows = _pair("placed", **PLACE) + _pair("named", **own) + _pair("half", **{**own, **PLACE, "stlo": None}) + _pair("both", **{**own, **PLACE}) + _pair("lacking", range(8), **own)
    seen = Observation()
    got = {}
    for r in rotate.rotate_records(spark.createDataFrame(rows, SCHEMA), seen=seen).collect():
        got.setdefault(r.pair, {})[r.slot] = r
    assert seen.get == {"pairs": 5, "pairs_not_rotated": 1} and set(got) == {"placed", "named", "half", "both"}
    assert {k: v[0].geometry for k, v in got.items()} == {"placed": "coordinates", "named": "header", "half": "header", "both": "coordinates"}
    assert got["both"][3].azimuth_deg == got["placed"][3].azimuth_deg == pytest.approx(67.3, abs=0.5) and got["half"][0].distance_km == 111.0
    x = np.array([r[2] for r in _pair("p")])
    for held in got.values():
        want = _rotated(x, held[0].azimuth_deg, held[0].back_azimuth_deg)
        assert np.allclose(np.array([held[k].data for k in range(9)]), want) and [held[k].component_pair for k in range(9)] == rotate.RTZ


@pytest.mark.parametrize(
    ("change", "text"),
    [({"az": None}, "neither coordinates nor azimuths"), ({"delta": None}, "different sampling intervals"), ("delta", "different sampling intervals"), ("width", "different lengths")],
)
def test_records_that_cannot_be_rotated_are_errors(spark, change, text):
    own = {"delta": 0.5, "az": 30.0, "baz": 215.0}
    if change == "delta":
        rows = _pair("p", range(8), **own) + _pair("p", (8,), **{**own, "delta": 0.5001})
    elif change == "width":
        rows = _pair("p", range(8), **own) + _pair("p", (8,), width=5, **own)
    else:
        rows = _pair("p", **{**own, **change})
    with pytest.raises(Exception, match=f"{text}.*pair p"):
        rotate.rotate_records(spark.createDataFrame(rows, SCHEMA)).collect()


def test_files_of_a_run_are_rotated_as_its_stacks(spark, tmp_path):
    rng = np.random.default_rng(4)
    for k, station in enumerate(("AA", "BB", "CC")):
        for comp in ("BHE", "BHN", "BHZ"):
            if (station, comp) == ("CC", "BHN"):
                continue
            path = tmp_path / "data" / "2022" / f"{station}.137.{comp}.sac"
            path.parent.mkdir(parents=True, exist_ok=True)
            path.write_bytes(sac.encode({"delta": 1.0, "stla": 10.0 + k, "stlo": 20.0 - k, "kstnm": station, "data": rng.normal(size=200)}))
    c = config.RunConfig(
        sources=[config.Source(str(tmp_path / "data"), "{home}/{YYYY}/{station}.{JJJ}.{channel}.sac", components=("BHE", "BHN", "BHZ"))],
        record_seconds=200, window_seconds=100, delta=1.0, max_lag_seconds=10, whiten="OFF", normalize="OFF", unpack_target="STACK", output=str(tmp_path / "out"),
    )
    run = Run(spark, c)
    with pytest.warns(UserWarning, match="1 groups have not 3 channels and are left out"):
        run.go()
    facts = {k: json.loads(spark.read.text(run.path(f"{k}.json")).first()[0]) for k in ("inventory", "spectra", "rotate")}
    assert facts["inventory"]["channels"] == 8 and facts["inventory"]["pairs"] == 3 and facts["inventory"]["pairs_without_coordinates"] == 0
    assert (facts["spectra"]["channels_read"], facts["spectra"]["channels_dropped"], facts["spectra"]["groups_dropped"], facts["spectra"]["spectra"]) == (8, 2, 1, 12)
    assert facts["rotate"] == {"linear_pairs": 1, "linear_pairs_not_rotated": 0}
    places = spark.createDataFrame([(str(p),) for p in (tmp_path / "out" / "sac" / "stack_linear").rglob("*.SAC")], "path string")
    assert places.count() == 9
    got = {r.component_pair: r.data for r in rotate.rotate_files(places).collect()}
    want = {r.component_pair: r.data for r in run.table("rotated_linear").collect()}
    assert got.keys() == want.keys() and all(np.allclose(got[k], want[k], rtol=1e-4, atol=1e-3 * np.abs(want[k]).max()) for k in want)
    assert rotate.rotate_files(places).select("pair").distinct().first().pair.endswith(".*.ncf.SAC")
