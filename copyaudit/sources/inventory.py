"""File inventories of directories, listed by Spark tasks.

A frame of directories goes in and a frame of files comes out: every task lists the directories of its rows, so neither
the directories nor the files pass through the driver, and a run asks for each directory once. Zero-length files are
files. Names that start with ``.`` or ``_`` (``_SUCCESS``, ``.crc``, ``_temporary/``) are not data, unless they name a partition.

Stores are reached from the tasks through pyarrow's file systems. A path without a scheme lies in the default file
system of the Hadoop configuration. Directories of other stores are asked through Hadoop's own client, by the driver.
"""

from __future__ import annotations

import fnmatch
import re
from collections.abc import Iterable, Iterator
from concurrent.futures import ThreadPoolExecutor
from functools import lru_cache
from urllib.parse import unquote

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from copyaudit.functions.paths import file_name

# Schemes of pyarrow's file systems, by the scheme that Hadoop paths use.
STORES = {"file": "file", "hdfs": "hdfs", "s3": "s3", "s3a": "s3", "s3n": "s3", "gs": "gs", "abfs": "abfs", "abfss": "abfss"}
LOOKUP_THREADS = 16      # calls to a store at a time, per task

# What a listing adds to the columns of its directories. A row without a path says why there is no file.
FOUND = StructType([StructField("path", StringType()), StructField("length", LongType()), StructField("modified", LongType()),
                    StructField("exception", StringType())])
NO_FILES = "no data files in the directory"


def qualified(path: str, default: str) -> str:
    """``scheme:[//authority]/path`` in one spelling: no doubled or trailing slash, ``file:/x`` for local paths."""
    scheme, authority, rest = re.fullmatch(r"(?s)(?:([A-Za-z][A-Za-z0-9+.-]*):)?(?://([^/]*))?(.*)", path).groups()
    if scheme is None:
        scheme, authority, _ = re.fullmatch(r"([^:]+):(?://([^/]*))?(.*)", default).groups()
    rest = re.sub("/+", "/", "/" + rest)
    return f"{scheme}:{'//' + authority if authority else ''}{rest.rstrip('/') or '/'}"


def default_store(spark: SparkSession) -> str:
    return spark.sparkContext._jsc.hadoopConfiguration().get("fs.defaultFS") or "file:///"


def is_data(relative: str) -> bool:
    return not any(part.startswith(".") or (part.startswith("_") and "=" not in part) for part in relative.split("/"))


@lru_cache(maxsize=64)
def _store(scheme: str, authority: str):
    return pafs.FileSystem.from_uri(f"{STORES[scheme]}://{authority}/")


def open_store(path: str) -> tuple[pafs.FileSystem, str]:
    """The file system of a qualified path and the path in it."""
    scheme, authority, rest = re.fullmatch(r"(?s)([^:]+):(?://([^/]*))?(/.*)", path).groups()
    if scheme not in STORES:
        raise ValueError(f"no file system for scheme: {scheme}")
    store, base = _store(scheme, authority or "")
    return store, base.rstrip("/") + rest


def by_tasks(path: str) -> bool:
    return path.split(":", 1)[0] in STORES


def list_files(directory: str, recursive: bool = True) -> list[tuple]:
    """``FOUND`` rows of a directory; none if it does not exist."""
    try:
        store, at = open_store(directory)
        found = store.get_file_info(pafs.FileSelector(at, recursive=recursive))
    except FileNotFoundError:
        return []
    except Exception as err:  # noqa: BLE001 - e.g. no permission, unknown scheme: an error row of this directory
        return [(None, None, None, _first_line(err))]
    skip = len(at.rstrip("/")) + 1
    rows = [(f"{directory}/{f.path[skip:]}", f.size, f.mtime_ns, None) for f in found if f.is_file and is_data(f.path[skip:])]
    return rows or [(None, None, None, NO_FILES)]


def child_directories(root: str, prefix: str) -> Iterator[tuple[str, str | None]]:
    """``(partition value, error)`` of the directories ``prefix=value`` below a root; none if the root does not exist."""
    try:
        store, at = open_store(root)
        found = store.get_file_info(pafs.FileSelector(at))
    except FileNotFoundError:
        return
    except Exception as err:  # noqa: BLE001 - as above
        yield None, _first_line(err)
        return
    for f in found:
        if f.type == pafs.FileType.Directory and f.base_name.startswith(f"{prefix}="):
            yield unquote(f.base_name.split("=", 1)[1]), None


def hadoop_files(spark: SparkSession, directory: str, recursive: bool = True) -> list[tuple]:
    """Like :func:`list_files`, through Hadoop's client on the driver, for stores that tasks cannot ask."""
    jvm = spark.sparkContext._jvm
    try:
        root = jvm.org.apache.hadoop.fs.Path(directory)
        store = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        if not store.exists(root):
            return []
        skip, found, rows = len(store.getFileStatus(root).getPath().toString()) + 1, store.listFiles(root, recursive), []
        while found.hasNext():
            f = found.next()
            name = f.getPath().toString()[skip:]
            if is_data(name):
                rows.append((f"{directory}/{name}", f.getLen(), f.getModificationTime() * 1_000_000, None))
    except Exception as err:  # noqa: BLE001 - as above
        reason = getattr(err, "java_exception", None)
        return [(None, None, None, reason.toString() if reason else _first_line(err))]
    return rows or [(None, None, None, NO_FILES)]


def _first_line(err: Exception) -> str:
    text = str(err)
    return text.splitlines()[0] if text else repr(err)


def rows_of(batch: pa.RecordBatch) -> list[tuple]:
    return list(zip(*(c.to_pylist() for c in batch.columns), strict=True))


def arrow_schema(schema: StructType) -> pa.Schema:
    kinds = {StringType(): pa.string(), LongType(): pa.int64()}
    return pa.schema([(f.name, kinds[f.dataType]) for f in schema])


def as_batch(rows: Iterable[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) or [()] * len(schema)
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)


def spread(df: DataFrame, *by: str) -> DataFrame:
    """Rows dealt to ``spark.sql.shuffle.partitions`` tasks, however few bytes they have: each row stands for calls to a store."""
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), *by)


def listed(directories: DataFrame, recursive: bool = True) -> DataFrame:
    """The files of directories: the columns of ``directories`` (strings, the last one ``dir``, qualified) and ``FOUND``."""
    spark = directories.sparkSession
    out = StructType([*directories.schema.fields, *FOUND.fields])
    types = arrow_schema(out)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with ThreadPoolExecutor(LOOKUP_THREADS) as pool:
            for batch in batches:
                rows = rows_of(batch)
                for at in range(0, len(rows), 256):
                    part = rows[at:at + 256]
                    found = pool.map(lambda r: list_files(r[-1], recursive), part)
                    yield as_batch([(*r, *f) for r, files in zip(part, found, strict=True) for f in files], types)

    in_tasks = F.split("dir", ":", 2)[0].isin(list(STORES))
    files = spread(directories.where(in_tasks)).mapInArrow(run, out)
    others = [tuple(r) for r in directories.where(~in_tasks).collect()]   # stores that only the driver's client reaches
    if not others:
        return files
    with ThreadPoolExecutor(LOOKUP_THREADS) as pool:
        found = pool.map(lambda r: hadoop_files(spark, r[-1], recursive), others)
    return files.unionByName(spark.createDataFrame([(*r, *f) for r, rows in zip(others, found, strict=True) for f in rows], out))


def file_listing(spark: SparkSession, path: str, recursive: bool = False,
                 glob: str | None = None) -> DataFrame:
    """S6 (flat) / S7 (recursive): ``path``, ``folder``, ``file_name``, ``length``; an unreadable folder raises."""
    folder = spark.createDataFrame([(qualified(path, default_store(spark)),)], "dir string")
    files = listed(folder, recursive)
    failed = F.coalesce(F.col("exception"), F.lit(NO_FILES)) != NO_FILES
    files = files.withColumn("path", F.when(failed, F.raise_error(F.col("exception"))).otherwise(F.col("path"))).where("path IS NOT NULL")
    if glob:
        files = files.where(file_name("path").rlike(fnmatch.translate(glob).replace(r"\Z", "$").replace(r"\z", "$")))
    return files.select("path", F.regexp_extract("path", "^(.*)/[^/]*$", 1).alias("folder"), file_name("path").alias("file_name"),
                        "length")


def folder_totals(listing: DataFrame, by: str = "folder") -> DataFrame:
    """A2/A3: number of files and total bytes per folder."""
    return (listing.groupBy(by)
            .agg(F.count(F.lit(1)).alias("files"), F.sum("length").alias("bytes")))
