import pytest
from pyspark.sql import functions as F

from noisefield.operators import lookup
from noisefield.plans import catalog
from noisefield.sources import record_lookup

STATIONS, SLOTS = 24, 9


def _index(spark, days):
    """Nine rows for each pair of stations on each day."""
    n = STATIONS * STATIONS * SLOTS
    k = F.col("id")
    letter = lambda x: F.element_at(F.array(*map(F.lit, "ENZ")), (x % 3 + 1).cast("int"))
    pair = F.floor(k / SLOTS) % (STATIONS * STATIONS)
    day = F.date_add(F.lit("2022-01-01").cast("date"), F.floor(k / n).cast("int"))
    return spark.range(days[0] * n, days[1] * n, 1, 4).select(
        F.date_format(day, "yyyy.DDD.0000").alias("timestamp"), F.concat(F.lit("S"), F.floor(pair / STATIONS)).alias("src_station"), F.concat(F.lit("S"), pair % STATIONS).alias("rec_station"),
        letter(F.floor(k / 3)).alias("src_component"), letter(k).alias("rec_component"), F.lit("p.sac").alias("record_path"), (k * 700).alias("record_offset"),
    )


def _read(df):
    """Rows of the result, and rows that the scan took out of row groups."""
    rows = df.collect()
    leaves = df._jdf.queryExecution().executedPlan().collectLeaves()
    plan = leaves.apply(0)
    if "QueryStage" in plan.getClass().getSimpleName():
        plan = plan.plan().collectLeaves().apply(0)
    return rows, plan.metrics().apply("numOutputRows").value(), plan.metrics().apply("numFiles").value()


def test_rows_read_stay_the_same_while_the_index_grows(spark, tmp_path):
    path = str(tmp_path / "index")
    ask = lambda time, src="S3", rec="S17", **kw: record_lookup.find(spark, path, time, src, rec, "E-Z", **kw)
    record_lookup.write(_index(spark, (0, 3)), path, group_bytes=16 << 10)
    first, read, files = _read(ask("2022.002.0000"))
    record_lookup.write(_index(spark, (3, 24)), path, group_bytes=16 << 10)
    again, read_later, files_later = _read(ask("2022.002.0000"))
    total = spark.read.parquet(path).count()
    assert len(first) == 1 and again == first and total == 24 * STATIONS * STATIONS * SLOTS
    assert 0 < read_later <= read < total / 60 and files_later == files
    # without a time a row group a day is read, by its bloom filter; of stations that no row has, none or hardly any
    rows, read, _ = _read(ask(None, allow_reverse=True).where("not reversed"))
    assert len(rows) == 24 and read < total / 2
    rows, read, _ = _read(ask(None, "S3", "X"))
    assert rows == [] and read < total / 20
    assert record_lookup.is_lookup(spark, path) and not record_lookup.is_lookup(spark, str(tmp_path))


def test_finds_what_a_plain_filter_finds(spark, tmp_path):
    df = spark.createDataFrame(
        [("2022-01-05T10:00", "A", "B", "E", "Z", 1), ("2022-01-05T10:00", "B", "A", "Z", "E", 2), ("STACK", "A", "B", "E", "Z", 3), (None, "A", "B", "E", "Z", 4), ("STACK", None, "B", "E", "Z", 5), ("STACK", "A", "B", "E", "Z", 3), ("2022.005.1000", "A|B", "", "E", "Z", 6)],
        "timestamp string, src_station string, rec_station string, src_component string, rec_component string, n int",
    )
    path = str(tmp_path / "index")
    record_lookup.write(df.where("n < 3"), path)
    record_lookup.write(df.where("n >= 3"), path)
    assert spark.read.parquet(path).count() == df.count()
    for time in ("2022-01-05T10:00", "2022-01-05T10_00", "STACK", None, "2022.005.1000", "2023.001.0000"):
        for src, rec in (("A", "B"), ("B", "A"), ("A|B", "")):
            for turn in (False, True):
                want = sorted((r.n, r.reversed) for r in lookup.extract(df, time, src, rec, "E-Z", turn).collect())
                assert sorted((r.n, r.reversed) for r in record_lookup.find(spark, path, time, src, rec, "E-Z", turn).collect()) == want
    with pytest.raises(ValueError, match="index_pair"):
        record_lookup.write(df.withColumn("index_pair", F.lit(1)), str(tmp_path / "other"))
    record_lookup.write(df.where("false"), path)
    assert record_lookup.find(spark, path, "STACK", "A", "B", "E/Z").count() == 2


def test_query(same_as_sql):
    same_as_sql(catalog.extract_indexed, catalog.SQL["extract_indexed"])
