"""One commit per run: which runs count.

A run first writes its *intent* (its id, its name, where its rows will go), then its sinks, and last its *manifest*: one file,
renamed into place, that names the result files, control and failure folders of the run. A run without a manifest does
not count. Result files carry the run's id in their names, so its rows can be told from those of other runs in a table
whose columns are fixed.

A run that was killed is undone by the next run of the same name (the same audit of the same items), which takes its files
away before it writes its own. Runs of other names are never touched, so audits may run at the same time; two runs of one
name at a time are not supported.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

# Fixed value: Hadoop's setting for the first part of output file names.
FILE_PREFIX = "mapreduce.output.basename"


class Journal:
    """Intents and manifests of runs, small JSON files below one folder."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        self.jvm, self.conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()

    def _at(self, path: str):
        at = self.jvm.org.apache.hadoop.fs.Path(path)
        return at.getFileSystem(self.conf), at

    def _names(self, kind: str) -> set[str]:
        store, at = self._at(f"{self.path}/{kind}")
        if not store.exists(at):
            return set()
        names = {s.getPath().getName() for s in store.listStatus(at)}
        return {n.removesuffix(".json") for n in names if n.endswith(".json") and not n.startswith((".", "_"))}

    def _write(self, kind: str, run: str, content: dict) -> None:
        """The file appears whole or not at all."""
        store, draft = self._at(f"{self.path}/{kind}/_{run}.json")
        out = store.create(draft, True)
        out.write(json.dumps(content).encode())
        out.close()
        if not store.rename(draft, self._at(f"{self.path}/{kind}/{run}.json")[1]):
            raise OSError(f"cannot write {self.path}/{kind}/{run}.json")

    def read(self, kind: str, run: str) -> dict:
        store, at = self._at(f"{self.path}/{kind}/{run}.json")
        source = store.open(at)
        try:
            return json.loads(bytes(source.readAllBytes()).decode())
        finally:
            source.close()

    def begin(self, run: str, name: str, places: dict) -> None:
        for dead in sorted(self._names("intent") - self._names("manifest")):
            intent = self.read("intent", dead)
            if intent["name"] == name:
                self.undo(dead, intent["places"])
        self._write("intent", run, {"name": name, "places": places})

    def commit(self, run: str, name: str, places: dict) -> None:
        files = [f.getPath().toString() for f in self._result_files(run, places)]
        self._write("manifest", run, {"name": name, "places": places, "result_files": files})

    def undo(self, run: str, places: dict) -> None:
        """Takes away everything a run wrote, its intent last, so that an undo that is killed is repeated."""
        for f in self._result_files(run, places):
            f.getPath().getFileSystem(self.conf).delete(f.getPath(), False)
        if places.get("result_table"):
            self.spark.catalog.refreshTable(places["result_table"])
        for folder in places["folders"]:
            for at in (f"{folder}/run={run}", f"{folder}/_audited/run={run}"):
                store, path = self._at(at)
                store.delete(path, True)
        store, path = self._at(f"{self.path}/intent/{run}.json")
        store.delete(path, False)

    def _result_files(self, run: str, places: dict) -> list:
        if not places.get("result_location"):
            return []
        store, pattern = self._at(f"{places['result_location']}/partition_date=*/{file_prefix(run)}-*")
        return list(store.globStatus(pattern) or [])

    def uncommitted(self) -> set[str]:
        """Runs that have begun here and do not count."""
        return self._names("intent") - self._names("manifest")


def file_prefix(run: str) -> str:
    return f"run-{run}"


@contextmanager
def named_files(spark: SparkSession, run: str) -> Iterator[None]:
    """Files written inside carry the run's id."""
    before = spark.conf.get(FILE_PREFIX, None)
    spark.conf.set(FILE_PREFIX, file_prefix(run))
    try:
        yield
    finally:
        spark.conf.unset(FILE_PREFIX) if before is None else spark.conf.set(FILE_PREFIX, before)


def table_location(spark: SparkSession, table: str) -> str:
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {table}").where(F.col("col_name") == "Location").select("data_type").collect()
    return rows[0][0].rstrip("/")
