"""Day-partitioned Parquet lakes: three folder layouts, inventory, incremental rebuild of days, streams of files."""

from __future__ import annotations

import hashlib
import re
import tempfile
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

#: Layouts of a day in a path: YYYY/MM/DD, key=YYYY-MM-DD and YYYY-MM-DD.
DAY_IN_PATH = r"/(?:\w+=)?(\d{4})[-/](\d{2})[-/](\d{2})/[^/]*$"


def work_folder(spark: SparkSession, name: str) -> str:
    """A new folder that all executors share: below spark.checkpoint.dir. Only a local master may do without that setting (tests)."""
    top = spark.conf.get("spark.checkpoint.dir", None)
    if not top:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        top = f"file://{tempfile.gettempdir()}/spark-lake"
    return f"{top.rstrip('/')}/lake/{name}-{uuid.uuid4().hex}"


def kept(rows: DataFrame) -> DataFrame:
    """rows written once, for steps that read them many times: a reliable checkpoint, which Spark's cleaner deletes when nothing refers to it
    any more (spark.cleaner.referenceTracking.cleanCheckpoints)."""
    context = rows.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(work_folder(rows.sparkSession, "kept"))
    return rows.checkpoint()


def path_day(path: Column) -> Column:
    """SCAN-3: the day a file's folder stands for; null without one."""
    part = lambda i: F.regexp_extract(path, DAY_IN_PATH, i)
    return F.when(part(1) != "", F.make_date(part(1).cast("int"), part(2).cast("int"), part(3).cast("int")))


def read_days(spark: SparkSession, folder: str, start: str | None = None, end: str | None = None) -> DataFrame:
    """SCAN-1, SCAN-3: all files below a folder with their folder's day; schemas are merged by name. A range without any file is an error."""
    inside = F.lit(True)
    if start:
        inside = inside & (F.col("folder_day") >= F.lit(start).cast("date"))
    if end:
        inside = inside & (F.col("folder_day") <= F.lit(end).cast("date"))
    if (start or end) and files_of(spark, folder).withColumnRenamed("day", "folder_day").where(inside).isEmpty():
        raise FileNotFoundError(f"{folder} has no file of {start or 'the first day'} to {end or 'the last'}")
    rows = spark.read.option("mergeSchema", True).option("recursiveFileLookup", True).parquet(folder)
    return rows.withColumn("folder_day", path_day(F.col("_metadata.file_path"))).where(inside)


def files_of(spark: SparkSession, folder: str) -> DataFrame:
    """(path, bytes, loaded, day, layout) of the Parquet files below a folder: from its listing, without reading a file."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.parquet").load(folder)
    relative = F.regexp_replace(F.regexp_replace("path", "^[^/]*:/+", "/"), "^" + re.escape(re.sub("^[^/]*:/+", "/", folder.rstrip("/"))), "")
    named = F.regexp_replace(F.regexp_replace(F.regexp_extract(relative, "^/?(.*?)/?[^/]*$", 1), r"\d", "N"), "NNNN([-/])NN[-/]NN", "YYYY$1MM$1DD")
    return files.select("path", F.col("length").alias("bytes"), F.col("modificationTime").alias("loaded"), path_day(F.col("path")).alias("day"), F.when(named == "", "(no folders)").otherwise(named).alias("layout"))


def footers(files: DataFrame) -> DataFrame:
    """META-2, META-3: files with n_rows, row_groups, columns (name and type each) and schema_hash, from the footers, which tasks read."""
    schema = "path string, n_rows long, row_groups int, columns array<struct<name:string,type:string>>, schema_hash string"

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for path in batch.column("path").to_pylist():
                system, inner = fs.FileSystem.from_uri(re.sub("^file:/+", "file:///", path))
                with system.open_input_file(inner) as f:
                    meta = pq.read_metadata(f)
                columns = [{"name": c.name, "type": str(c.type)} for c in meta.schema.to_arrow_schema()]
                digest = hashlib.md5("\n".join(f"{c['name']} {c['type']}" for c in columns).encode()).hexdigest()
                found.append((path, meta.num_rows, meta.num_row_groups, columns, digest))
            kinds = (pa.string(), pa.int64(), pa.int32(), pa.list_(pa.struct([("name", pa.string()), ("type", pa.string())])), pa.string())
            if found:
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*found), kinds)], names=["path", "n_rows", "row_groups", "columns", "schema_hash"])

    return files.join(files.select("path").mapInArrow(read, schema), "path")


def table_inventory(files: DataFrame) -> DataFrame:
    """META-1..3: one row on a table from its files and footers: files, bytes, layout, days and missing days between, rows per day, number of
    schemas, and what columns its last file has or lacks against the first. A table has a row per day, few to list."""
    per_day = files.where("day is not null").groupBy("day").agg(F.sum("n_rows").alias("n"))
    gaps = per_day.agg(F.min("day").alias("a"), F.max("day").alias("b"), F.collect_set("day").alias("have")).select(F.array_except(F.sequence("a", "b"), "have").alias("missing_days"))
    days = per_day.agg(F.min("day").alias("first_day"), F.max("day").alias("last_day"), F.count("*").alias("n_days"), F.percentile("n", 0.5).alias("rows_per_day"), F.min("n").alias("least_rows"), F.max("n").alias("most_rows"))
    order = F.struct(F.coalesce("day", F.lit("0001-01-01").cast("date")).alias("d"), "path")
    names = lambda c: F.transform(c, lambda x: x["name"])
    first, last = names(F.min_by("columns", order)), names(F.max_by("columns", order))
    whole = files.agg(F.count("*").alias("files"), F.sum("bytes").alias("bytes"), F.sum("n_rows").alias("n_rows"), F.mode("layout").alias("layout"), F.count_distinct("schema_hash").alias("schemas"), F.array_sort(F.array_except(last, first)).alias("added"), F.array_sort(F.array_except(first, last)).alias("removed"))
    return whole.join(F.broadcast(days)).join(F.broadcast(gaps))


def days_to_rebuild(source: DataFrame, cache: DataFrame, required: list[str], restated: int = 7) -> DataFrame:
    """CACHE-4, CACHE-6, DQ-9: (day, reason) of days of source files that the cache must build again: it lacks them (missing), a required column
    (columns), a file that came in later than the cached day (late), or they are among the last ones, which the source restates."""
    s = source.where("day is not null").groupBy("day").agg(F.max("loaded").alias("_source"))
    has = F.forall(F.array(*[F.lit(c) for c in required]), lambda c: F.array_contains(F.transform("columns", lambda x: x["name"]), c))
    c = cache.withColumn("_whole", has).groupBy("day").agg(F.min("loaded").alias("_cache"), F.bool_and("_whole").alias("_whole"))
    last = s.agg(F.date_sub(F.max("day"), restated - 1).alias("_from"))
    rows = s.join(c, "day", "left").join(F.broadcast(last))
    reason = F.when(F.col("_cache").isNull(), "missing").when(~F.col("_whole"), "columns").when(F.col("_source") > F.col("_cache"), "late").when(F.col("day") >= F.col("_from"), "restated")
    return rows.select("day", reason.alias("reason")).where("reason is not null")


def _file_system(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    place = jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), place


def swap_partitions(spark: SparkSession, staged: str, target: str, depth: int) -> int:
    """CACHE-4, SINK-1: puts each partition folder of staged, `depth` levels down, in the place of that of target, and no others. A folder is
    renamed as a whole, so readers see the old or the new one; folders are few (a day or brand each). Returns how many there were."""
    jvm = spark.sparkContext._jvm
    system, top = _file_system(spark, staged)
    pattern = jvm.org.apache.hadoop.fs.Path(top, "/".join(["*=*"] * depth))
    moved = 0
    for status in system.globStatus(pattern):
        inner = status.getPath().toUri().getPath()[len(top.toUri().getPath()) :].lstrip("/")
        place = jvm.org.apache.hadoop.fs.Path(f"{target.rstrip('/')}/{inner}")
        old = jvm.org.apache.hadoop.fs.Path(f"{target.rstrip('/')}/_old-{uuid.uuid4().hex}")
        system.mkdirs(place.getParent())
        had = system.exists(place) and system.rename(place, old)
        if not system.rename(status.getPath(), place):
            raise OSError(f"could not move {status.getPath()} to {place}")
        if had:
            system.delete(old, True)
        moved += 1
    system.delete(top, True)
    return moved


def checked_overwrite(rows: DataFrame, path: str, by: tuple[str, ...], metrics: dict[str, Column], conditions: dict[str, Callable[[dict], bool]]) -> dict:
    """SINK-1, JOIN-10, DQ-9: replaces the partitions that rows has if all conditions on what was written hold, and no others.

    metrics are aggregates that the write itself observes, so rows are computed once; conditions see their values by name. If one fails, the
    staged files go, the table keeps what it had, and ValueError names the conditions and values. Returns the values.
    """
    spark = rows.sparkSession
    staged = f"{path.rstrip('/')}/_staged-{uuid.uuid4().hex}"
    seen = Observation()
    rows.observe(seen, *[c.alias(n) for n, c in metrics.items()]).write.partitionBy(*by).parquet(staged)
    values = seen.get
    failed = [name for name, holds in conditions.items() if not holds(values)]
    if failed:
        system, place = _file_system(spark, staged)
        system.delete(place, True)
        raise ValueError(f"not written: {', '.join(failed)} with {values}")
    swap_partitions(spark, staged, path, len(by))
    return values


def inventory(spark: SparkSession, folder: str) -> DataFrame:
    """META-1, META-2: files, bytes, rows and days per folder day."""
    rows = spark.read.option("mergeSchema", True).option("recursiveFileLookup", True).parquet(folder)
    files = rows.groupBy(F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_size").alias("bytes")).agg(F.count("*").alias("n_rows"))
    return files.groupBy(path_day(F.col("path")).alias("day")).agg(F.count("*").alias("files"), F.sum("bytes").alias("bytes"), F.sum("n_rows").alias("n_rows"), F.min("n_rows").alias("least_rows"), F.max("n_rows").alias("most_rows"))


def days_to_build(source_days: DataFrame, built_days: DataFrame, restated: int = 7) -> DataFrame:
    """CACHE-4: days that are missing, and the last ones, which the source restates."""
    last = source_days.agg(F.date_sub(F.max("day"), restated - 1).alias("_from"))
    missing = source_days.select("day").distinct().join(built_days.select("day").distinct(), "day", "left_anti")
    recent = source_days.select("day").distinct().join(F.broadcast(last)).where("day >= _from").select("day")
    return missing.union(recent).distinct()


def column_profile(rows: DataFrame, day: str, columns: list[str]) -> DataFrame:
    """META-4: per day and column: type, rows, nulls, least and greatest value as text."""
    kinds = {f.name: f.dataType.simpleString() for f in rows.schema.fields}
    parts = [p.alias(f"{c}__{k}") for c in columns for k, p in (("nulls", F.count_if(F.col(c).isNull())), ("low", F.min(c).cast("string")), ("high", F.max(c).cast("string")))]
    wide = rows.groupBy(F.col(day).alias("day")).agg(F.count("*").alias("n_rows"), *parts)
    cells = F.array(*[F.struct(F.lit(c).alias("column"), F.lit(kinds[c]).alias("type"), *[F.col(f"{c}__{k}").alias(k) for k in ("nulls", "low", "high")]) for c in columns])
    return wide.select("day", "n_rows", F.explode(cells).alias("c")).select("day", "n_rows", "c.*")


def replace_rows(store: DataFrame, new: DataFrame, key: list[str]) -> DataFrame:
    """SINK-2: a feature store in which rows of the same cutoffs as new are replaced."""
    return store.join(new.select(*key).distinct(), key, "left_anti").unionByName(new)


def overwrite_days(rows: DataFrame, path: str, by: tuple[str, ...] = ("day",)) -> None:
    """SINK-1, SINK-2, CACHE-4: replaces the partitions that rows has, and no others; a rerun gives the same lake."""
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*by).parquet(path)
