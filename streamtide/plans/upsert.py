"""The weather table as a snapshot and a log, with a job that folds the log.

The log takes observations by day and batch. Folding the days before a given one writes their
latest observations, one row per hour and place, as a new version, then a manifest that says
which version each day has, and only then deletes what went in. A reader takes the last complete
manifest, the snapshots that it names and all of the log that there is. The latest of an hour and
place is a maximum, so rows that are in both count once: the answer is the same before a fold, at
any moment of one, and after it, and late rows for a folded day simply lie in the log until the
next fold.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from streamtide import schemas
from streamtide.plans.ingest import latest_weather
from streamtide.session import drop_folder, has_folder
from streamtide.sinks import tables as sinks

MANIFEST = "day date, version long"


def append(obs: DataFrame, root: str, batch: str) -> None:
    """Observations to the log; a batch that is written again replaces its own folders."""
    sinks.append_weather(obs, f"{root}/log", batch)


def current(spark: SparkSession, root: str) -> tuple[int, DataFrame]:
    """The number of the last complete manifest, and its lines; 0 and none before the first."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(f"{root}/manifest")
    fs = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    names = [x.getPath().getName() for x in fs.listStatus(folder)] if fs.exists(folder) else []
    for number in sorted((int(n.removeprefix("fold=")) for n in names if n.startswith("fold=")), reverse=True):
        if has_folder(spark, f"{root}/manifest/fold={number}/_SUCCESS"):
            return number, spark.read.schema(MANIFEST).parquet(f"{root}/manifest/fold={number}")
    return 0, spark.createDataFrame([], MANIFEST)


def snapshots(spark: SparkSession, root: str, lines: DataFrame, schema: str = schemas.WEATHER_OBS) -> DataFrame:
    """The folded rows; the lines prune the folders of versions and days."""
    if not has_folder(spark, f"{root}/snapshots"):
        return spark.createDataFrame([], f"{schema}, day date")
    stored = spark.read.schema(f"{schema}, version long, day date").parquet(f"{root}/snapshots")
    return stored.join(lines, ["version", "day"], "left_semi").drop("version")


def log(spark: SparkSession, root: str, schema: str = schemas.WEATHER_OBS) -> DataFrame:
    if not has_folder(spark, f"{root}/log"):
        return spark.createDataFrame([], f"{schema}, day date, batch string")
    return spark.read.schema(f"{schema}, day date, batch string").parquet(f"{root}/log")


def latest(spark: SparkSession, root: str, *tie_break: str, schema: str = schemas.WEATHER_OBS, days: tuple[str, str] | None = None) -> DataFrame:
    """The last observation of each hour and place, of all days or those between two.

    ``tie_break`` columns settle observations of one time, as in ``latest_weather``.
    """
    _, lines = current(spark, root)
    rows = snapshots(spark, root, lines, schema).unionByName(log(spark, root, schema).drop("batch"))
    if days is not None:
        rows = rows.where(F.col("day").between(F.lit(days[0]).cast("date"), F.lit(days[1]).cast("date")))
    return latest_weather(rows.drop("day"), *tie_break)


def fold(spark: SparkSession, root: str, before: str, *tie_break: str, schema: str = schemas.WEATHER_OBS, sweep: bool = True) -> int:
    """Folds the log of the days before ``before`` (``yyyy-MM-dd``); the number of the manifest.

    Only days that have log rows are read and written. A fold that fails leaves folders that no
    manifest names; the next one takes another number and folds the same rows. ``sweep`` false
    leaves the folded folders to ``swept``, for readers that may still be at work.
    """
    closed = log(spark, root, schema).where(F.col("day") < F.lit(before).cast("date"))
    folders = [(str(r["day"]), r["batch"]) for r in closed.select("day", "batch").distinct().collect()]  # folder names
    number, lines = current(spark, root)
    if not folders:
        return number
    touched = closed.select("day").distinct()
    version = number + 1
    while has_folder(spark, f"{root}/snapshots/version={version}"):
        version += 1
    rows = snapshots(spark, root, lines, schema).join(touched, "day", "left_semi").unionByName(closed.drop("batch"))
    day = F.to_date(F.substring("hour_key", 1, 8), "yyyyMMdd")
    folded = latest_weather(rows.drop("day"), *tie_break).withColumn("day", day)
    folded.hint("rebalance", "day").write.partitionBy("day").parquet(f"{root}/snapshots/version={version}")
    kept = lines.join(touched, "day", "left_anti").unionByName(touched.withColumn("version", F.lit(version).cast("long")))
    kept.coalesce(1).write.parquet(f"{root}/manifest/fold={version}")  # a line per day
    if sweep:
        swept(spark, root, folders)
    return version


def swept(spark: SparkSession, root: str, folders: list[tuple[str, str]]) -> None:
    """Deletes folded log folders, and snapshots and manifests that are no longer named."""
    for day, batch in folders:
        drop_folder(spark, f"{root}/log/day={day}/batch={batch}")
    number, lines = current(spark, root)
    named = {(r["version"], str(r["day"])) for r in lines.collect()}  # a line per day
    for version in range(1, number):
        folder = f"{root}/snapshots/version={version}"
        if not has_folder(spark, folder):
            continue
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        days = [x.getPath().getName() for x in path.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(path)]
        for name in days:
            if name.startswith("day=") and (version, name.removeprefix("day=")) not in named:
                drop_folder(spark, f"{folder}/{name}")
        drop_folder(spark, f"{root}/manifest/fold={version}")
