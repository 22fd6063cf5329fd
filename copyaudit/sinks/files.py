"""Control records and failure files (K3, K4, K5).

Control records are rows (``control_dir, control_name, outcome, partition_date``), failure rows are header-less CSV
(``message, exception`` first, as downstream readers expect). Both are datasets with one folder per run, ``run=<id>``,
below the given path: a run only adds its folder, so it can neither lose the rows of another run nor leave half of its
own behind an overwrite. Each run also writes the keys it audited; readers take, per key, the rows of the last run that
audited it, so a rerun replaces exactly the keys it repeats, also where it has no row for them any more.
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Iterator
from concurrent.futures import ThreadPoolExecutor

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from copyaudit.schemas import CONTROL
from copyaudit.sinks.journal import Journal
from copyaudit.sources.inventory import LOOKUP_THREADS, by_tasks, default_store, open_store, qualified, rows_of


KEYS = ["db", "table", "partition_date"]
AUDITED = "_audited"        # hidden from plain readers of the folder


def new_run_id() -> str:
    """Ids of later runs sort after those of earlier ones."""
    return f"{time.time_ns():020d}-{uuid.uuid4().hex[:8]}"


def _latest(rows: DataFrame, audited: DataFrame) -> DataFrame:
    """The rows of the last run that audited their key; rows without a key (null parts) stay with their own run."""
    last = audited.groupBy(*KEYS).agg(F.max("run").alias("last_run"))
    named = last.select(*[F.col(k).alias(f"k_{k}") for k in KEYS], "last_run")
    same = [F.col(k).eqNullSafe(F.col(f"k_{k}")) for k in KEYS]
    return rows.join(named, same, "left").where(F.col("last_run").isNull() | (F.col("run") == F.col("last_run"))) \
        .drop("last_run", *[f"k_{k}" for k in KEYS])


def _write_run(rows: DataFrame, audited: DataFrame, path: str, run: str, csv: bool) -> None:
    """Adds the folder of one run: first its rows, then the keys that make them count."""
    writer = rows.write.mode("error")
    writer.option("header", "false").csv(f"{path}/run={run}") if csv else writer.orc(f"{path}/run={run}")
    audited.select(*KEYS).distinct().write.mode("error").orc(f"{path}/{AUDITED}/run={run}")


def _audited(spark: SparkSession, path: str) -> DataFrame:
    schema = "db string, `table` string, partition_date string, run string"
    return spark.read.schema(schema).option("basePath", f"{path}/{AUDITED}").orc(f"{path}/{AUDITED}/run=*")


CONTROL_FILE = "db string, `table` string, control_dir string, control_name string, outcome string, partition_date string"


def write_controls(controls: DataFrame, path: str, audited: DataFrame | None = None, run: str | None = None) -> None:
    """K3/K4: one control row per audited key. ``audited`` holds all keys of the run (default: those with a row)."""
    rows = controls.select("db", "table", *[f.name for f in CONTROL.fields])
    _write_run(rows, controls if audited is None else audited, path, run or new_run_id(), csv=False)


def _counting(rows: DataFrame, journal: str | None) -> DataFrame:
    """Without the rows of runs that have begun in a journal and are not committed there."""
    if journal is None:
        return rows
    return rows.where(~F.col("run").isin(*Journal(rows.sparkSession, journal).uncommitted()))


def read_controls(spark: SparkSession, path: str, journal: str | None = None) -> DataFrame:
    """The control records that count; with the ``journal`` of the runs, those of committed runs only."""
    rows = spark.read.schema(CONTROL_FILE + ", run string").option("basePath", path).orc(f"{path}/run=*")
    return _latest(_counting(rows, journal), _counting(_audited(spark, path), journal)).select(*[f.name for f in CONTROL.fields])


FAILURE_CSV_COLUMNS = ["message", "exception", "stage", "db", "table", "partition_date", "ordinal"]
FAILURE_FILE = ("message string, exception string, stage string, db string, `table` string, "
                "partition_date string, ordinal int")


def write_failures(failures: DataFrame, path: str, name_col: str | None = None, audited: DataFrame | None = None,
                   run: str | None = None) -> None:
    """K5: failure rows as CSV without header.

    With ``name_col`` (e.g. the registration failure file name) that column becomes a directory level, each table's
    failures sit in their own folder, and only the folders named in this run are replaced.
    """
    if name_col:
        failures.select(*FAILURE_CSV_COLUMNS, name_col).write.mode("overwrite").option("header", "false") \
            .partitionBy(name_col).option("partitionOverwriteMode", "dynamic").csv(path)
        return
    _write_run(failures.select(*FAILURE_CSV_COLUMNS), failures if audited is None else audited, path,
               run or new_run_id(), csv=True)


def read_failures(spark: SparkSession, path: str, name_col: str | None = None, journal: str | None = None) -> DataFrame:
    if name_col:
        return spark.read.schema(f"{FAILURE_FILE}, {name_col} string").option("header", "false").csv(path) \
            .select(*FAILURE_CSV_COLUMNS, name_col)
    rows = spark.read.schema(f"{FAILURE_FILE}, run string").option("header", "false").option("basePath", path) \
        .csv(f"{path}/run=*")
    return _latest(_counting(rows, journal), _counting(_audited(spark, path), journal)).select(*FAILURE_CSV_COLUMNS)


def _write_marker(path: str, other: str) -> None:
    store, at = open_store(path)
    store.create_dir(at.rsplit("/", 1)[0], recursive=True)
    store.open_output_stream(at).close()
    try:
        store.delete_file(open_store(other)[1])
    except FileNotFoundError:
        pass


def write_marker_files(spark: SparkSession, controls: DataFrame) -> int:
    """Optional: the control records as empty files ``<control_dir>/<control_name>``.

    For consumers that wait for marker files by name. Spark's writers cannot name files, so the tasks that hold the control
    rows create them; writing one twice (a retried or speculative task) changes nothing. The marker of the opposite
    outcome is removed, so a rerun never leaves a stale one behind. Returns the number of markers written.
    """
    default = default_store(spark)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def one(row):
            folder, name, outcome = row
            folder = qualified(folder, default)
            if not by_tasks(folder):
                return 0
            _write_marker(f"{folder}/{name}", f"{folder}/{name.rsplit('.', 1)[0]}.{'nonmatch' if outcome == 'match' else 'match'}")
            return 1

        with ThreadPoolExecutor(LOOKUP_THREADS) as pool:
            for batch in batches:
                written = list(pool.map(one, rows_of(batch)))
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(written, pa.int32())],
                                                 names=["control_dir", "control_name", "outcome", "written"])

    done = controls.select("control_dir", "control_name", "outcome") \
        .mapInArrow(write, "control_dir string, control_name string, outcome string, written int").persist()
    try:
        written = done.agg(F.coalesce(F.sum("written"), F.lit(0))).first()[0]
        return written + sum(_marker_by_driver(spark, r) for r in done.where("written = 0").toLocalIterator())
    finally:
        done.unpersist()


def _marker_by_driver(spark: SparkSession, row) -> int:
    """A marker in a store that only Hadoop's client reaches."""
    Path, conf = spark.sparkContext._jvm.org.apache.hadoop.fs.Path, spark.sparkContext._jsc.hadoopConfiguration()
    marker = Path(f"{row['control_dir']}/{row['control_name']}")
    store = marker.getFileSystem(conf)
    store.create(marker, True).close()                            # creates the directories above it
    other = "nonmatch" if row["outcome"] == "match" else "match"
    store.delete(Path(f"{row['control_dir']}/{row['control_name'].rsplit('.', 1)[0]}.{other}"), False)
    return 1
