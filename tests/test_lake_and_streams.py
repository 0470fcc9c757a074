import datetime as dt

import pytest
from pyspark.sql import functions as F

from lakepulse.sources import lake
from lakepulse.streaming import events as ev


def day(n):
    return dt.date(2025, 1, n)


def test_layouts_of_days(spark):
    paths = ["s3://b/t/2025/01/03/a.parquet", "file:/t/dt=2025-01-04/p.parquet", "/t/2025-01-05/p.parquet", "/t/p.parquet"]
    got = [r[0] for r in spark.createDataFrame([(p,) for p in paths], "p string").select(lake.path_day(F.col("p"))).collect()]
    assert got == [day(3), day(4), day(5), None]


def test_rebuilt_days_replace_only_themselves(spark, tmp_path):
    path = str(tmp_path / "t")
    lake.overwrite_days(spark.createDataFrame([(day(1), 1), (day(2), 2)], "day date, x int"), path)
    lake.overwrite_days(spark.createDataFrame([(day(2), 3)], "day date, x int"), path)
    assert sorted(tuple(r) for r in spark.read.parquet(path).select("day", "x").collect()) == [(day(1), 1), (day(2), 3)]
    assert {(r.day, r.files, r.n_rows) for r in lake.inventory(spark, path).collect()} == {(day(1), 1, 1), (day(2), 1, 1)}
    assert [r.x for r in lake.read_days(spark, path, "2025-01-02").select("x").collect()] == [3]


def test_days_to_build(spark):
    frame = lambda ns: spark.createDataFrame([(day(n),) for n in ns], "day date")
    got = lake.days_to_build(frame(range(1, 13)), frame([1, 2, 4, 5, 6, 7, 8, 9, 10]), 7).collect()
    assert sorted(r.day.day for r in got) == [3, 6, 7, 8, 9, 10, 11, 12]


def test_streams(spark, sf, tmp_path):
    rows = spark.read.parquet(f"{sf}/events.parquet").withColumn("ts", F.col("ts").cast("timestamp"))
    folder = str(tmp_path / "in")
    rows.unionByName(rows.where("event_id % 10 = 0")).coalesce(1).write.parquet(folder)
    stream = spark.readStream.schema(rows.schema).parquet(folder)

    def run(df, name):
        q = df.writeStream.outputMode("append").format("memory").queryName(name).option("checkpointLocation", str(tmp_path / name)).start()
        q.processAllAvailable()
        q.stop()
        return spark.table(name)

    assert run(ev.first_messages(stream, "event_id", late="60 days"), "firsts").count() == rows.count()
    found = run(ev.tumbling(stream, ["event_type"], "value"), "hours")
    want = rows.unionByName(rows.where("event_id % 10 = 0")).groupBy(F.window("ts", "1 hour").start.alias("start"), "event_type").agg(F.count("*").alias("n"))
    assert found.count() > 0 and found.select("start", "event_type", "n").exceptAll(want).count() == 0
    assert run(ev.session_windows(stream, "user_id"), "sess").count() > 0


def test_wrong_counts_stop_the_swap(spark, tmp_path):
    path = str(tmp_path / "t")
    rows = lambda *r: spark.createDataFrame([(day(n), x) for n, x in r], "day date, x int")
    seen = {"rows": F.count(F.lit(1)), "empty": F.count_if(F.col("x").isNull())}
    write = lambda r, n: lake.checked_overwrite(r, path, ("day",), seen, {"rows": lambda v: v["rows"] == n, "no nulls": lambda v: v["empty"] == 0})
    read = lambda: sorted((r.day, r.x) for r in spark.read.parquet(path).collect())
    assert write(rows((1, 1), (2, 2)), 2) == {"rows": 2, "empty": 0}
    for bad, n in ((rows((2, 9)), 2), (rows((2, None)), 1)):
        with pytest.raises(ValueError, match="not written"):
            write(bad, n)
        assert read() == [(day(1), 1), (day(2), 2)]
    write(rows((2, 5), (3, 6)), 2)
    assert read() == [(day(1), 1), (day(2), 5), (day(3), 6)]
    assert sorted(p.name for p in (tmp_path / "t").iterdir()) == ["day=2025-01-01", "day=2025-01-02", "day=2025-01-03"]


def test_days_without_files_are_an_error(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.createDataFrame([(day(1), 1)], "day date, x int").write.partitionBy("day").parquet(path)
    assert lake.read_days(spark, path, "2025-01-01", "2025-01-05").count() == 1
    with pytest.raises(FileNotFoundError, match="2025-01-02"):
        lake.read_days(spark, path, "2025-01-02", "2025-01-05")


def test_reasons_to_rebuild(spark):
    at = lambda h: dt.datetime(2025, 2, 1, h)
    source = spark.createDataFrame([(day(n), at(5 if n == 4 else 1)) for n in range(1, 21)], "day date, loaded timestamp")
    columns = [{"name": "a", "type": "x"}, {"name": "b", "type": "x"}]
    cache = spark.createDataFrame([(day(n), at(3), columns[: 1 if n == 3 else 2]) for n in range(1, 21) if n != 2], "day date, loaded timestamp, columns array<struct<name:string,type:string>>")
    got = {r.day.day: r.reason for r in lake.days_to_rebuild(source, cache, ["a", "b"], 3).collect()}
    assert got == {2: "missing", 3: "columns", 4: "late", 18: "restated", 19: "restated", 20: "restated"}
