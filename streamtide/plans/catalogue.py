"""Which runs there are and which folders belong to each, without a look at the data.

A line is a small file below ``source=<s>/day=<d>/run=<stamp>``; stamps begin with their day. The
newest run is the last folder of the last day, so it is found by listing days and the runs of one
day, and the folders of a run by listing that run. A line is put in place by a rename, so it is
there whole or not at all. A mark beside the lines names the run that a batch of a stream belongs
to: one that is done again by a later run moves there.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import SparkSession


@dataclass(frozen=True)
class Catalogue:
    root: str

    def _source(self, source: str) -> str:
        return f"{self.root.rstrip('/')}/source={source}"

    def _run(self, source: str, run: str) -> str:
        return f"{self._source(source)}/day={run[:10]}/run={run}"

    def record(self, spark: SparkSession, source: str, run: str, path: str, batch: str) -> None:
        """The folder belongs to the run, and to none that had the batch before."""
        mark = f"{self._source(source)}/batches/{batch}"
        for before in _read(spark, mark):
            if before != run:
                _delete(spark, f"{self._run(source, before)}/{batch}")
        _write(spark, mark, run)
        _write(spark, f"{self._run(source, run)}/{batch}", path)

    def paths(self, spark: SparkSession, source: str, run: str) -> list[str]:
        """The folders of a run: only its own lines are listed."""
        folder = self._run(source, run)
        return [line for name in _names(spark, folder) for line in _read(spark, f"{folder}/{name}")]

    def newest(self, spark: SparkSession, source: str) -> str | None:
        """The run with the highest stamp; None before the first one."""
        for day in reversed([x for x in _names(spark, self._source(source)) if x.startswith("day=")]):
            runs = [x.removeprefix("run=") for x in _names(spark, f"{self._source(source)}/{day}") if x.startswith("run=")]
            if runs:
                return runs[-1]
        return None


def _file_system(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place, place.getFileSystem(spark._jsc.hadoopConfiguration())


def _names(spark: SparkSession, folder: str) -> list[str]:
    place, fs = _file_system(spark, folder)
    if not fs.exists(place):
        return []
    names = [x.getPath().getName() for x in fs.listStatus(place)]
    return sorted(n for n in names if n[0] not in "._")


def _read(spark: SparkSession, path: str) -> list[str]:
    place, fs = _file_system(spark, path)
    if not fs.exists(place):
        return []
    stream = fs.open(place)
    try:
        return [stream.readUTF()]
    finally:
        stream.close()


def _write(spark: SparkSession, path: str, text: str) -> None:
    place, fs = _file_system(spark, path)
    beside = spark._jvm.org.apache.hadoop.fs.Path(place.getParent(), f".{place.getName()}")
    stream = fs.create(beside, True)
    try:
        stream.writeUTF(text)
    finally:
        stream.close()
    fs.delete(place, False)
    fs.rename(beside, place)


def _delete(spark: SparkSession, path: str) -> None:
    place, fs = _file_system(spark, path)
    fs.delete(place, False)
