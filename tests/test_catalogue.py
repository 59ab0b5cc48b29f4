"""The run catalogue: runs and their folders without a look at the data."""

from streamtide.operators import rollups
from streamtide.plans.catalogue import Catalogue


def scans(frame):
    plan = frame._jdf.queryExecution().executedPlan().toString()
    return plan.split("== Initial Plan ==")[0].count("FileScan")


def test_lines_of_a_run_and_the_newest(spark, tmp_path):
    own = Catalogue(str(tmp_path))
    assert own.newest(spark, "polls") is None and own.paths(spark, "polls", "2024-01-01T00-00-00") == []
    for run in ("2024-01-02T00-10-00", "2024-01-01T23-50-00", "2023-12-31T23-50-00"):
        for k in range(2):
            own.record(spark, "polls", run, f"/data/{run}/{k}", f"{run}-{k}")
    own.record(spark, "pages", "2025-01-01T00-00-00", "/data/pages", "q-0")
    assert own.newest(spark, "polls") == "2024-01-02T00-10-00"
    assert own.paths(spark, "polls", "2024-01-01T23-50-00") == [f"/data/2024-01-01T23-50-00/{k}" for k in range(2)]


def test_a_batch_done_again_moves_to_the_later_run(spark, tmp_path):
    own = Catalogue(str(tmp_path))
    first, second = "2024-01-01T23-50-00", "2024-01-02T00-00-00"
    for run in (first, first, second, second):
        own.record(spark, "polls", run, "/data/0", "q-0")
    assert own.paths(spark, "polls", first) == [] and own.paths(spark, "polls", second) == ["/data/0"]


def test_ten_thousand_lines(spark, tmp_path):
    """Of many lines only those of a run are read."""
    own = Catalogue(str(tmp_path))
    for day in range(1, 29):
        for k in range(360):
            run = f"2024-01-{day:02}T{k // 60:02}-{k % 60:02}-00"
            folder = tmp_path / "source=polls" / f"day={run[:10]}" / f"run={run}"
            folder.mkdir(parents=True)
            (folder / "line").write_bytes(b"")  # no line that could be read
    last = "2024-01-28T06-00-00"
    own.record(spark, "polls", last, "/data/last", "q-1")
    assert own.newest(spark, "polls") == last and own.paths(spark, "polls", last) == ["/data/last"]


def test_the_newest_batch_is_one_scan(spark, tmp_path):
    rows = spark.createDataFrame([(k, f"2024-01-0{1 + k % 3}T00-00-00") for k in range(30)], "id long, run string")
    path = str(tmp_path / "rows")
    rows.write.partitionBy("run").parquet(path)
    table = spark.read.schema(rows.schema).parquet(path)
    newest = rollups.newest_batch(table, "run", "2024-01-03T00-00-00")
    assert newest.count() == 10 and scans(newest) == 1 and newest.rdd.getNumPartitions() <= 10
    files = {f.rsplit("/", 2)[1] for f in newest.inputFiles()}
    assert "run=2024-01-03T00-00-00" in files
    other = rollups.newest_batch(table, "run")
    assert other.count() == 10 and scans(other) == 2
