"""Physical copies: record counts and file inventories per partition.

One path, whatever the number of tables, dates and copies, and nothing but counts passes through the driver:

1. **Directories.** The copies' roots and the work list's partitions give one row per partition directory to look at.
   Without partitions, tasks list the roots.
2. **Files.** Tasks list the directories (``sources.inventory``). A directory that is not there has no row; one that is
   there without data files, or cannot be listed, has an error row.
3. **Records.** Files are dealt to tasks one by one, and a task reads the number of records from the file's footer (ORC,
   Parquet). A file that cannot be read becomes an error row there and then; nothing is read again for it. Formats without
   such a number (Avro) are counted by Spark's reader, all their directories in one relation, per file path.
4. **Reruns.** With a folder of earlier counts, a file whose path, length and time of change are known there is not read
   again; the counts of the other files are added to it.

The output has ``COPY_STATS`` shape, one row per file and copy; ``copy_counts`` sums it.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from concurrent.futures import ThreadPoolExecutor
from dataclasses import astuple, dataclass

import pyarrow as pa
import pyarrow.orc
import pyarrow.parquet
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from copyaudit.schemas import COPY_STATS
from copyaudit.session import checkpoint_root
from copyaudit.sources.inventory import (LOOKUP_THREADS, _first_line, arrow_schema, as_batch, by_tasks, child_directories, default_store,
                                         listed, open_store, qualified, rows_of, spread)

# Reader class per logical format (Avro's short name needs the
# external module registered; its class name works without it).
READER_FORMATS = {
    "orc": "orc",
    "parquet": "parquet",
    "avro": "org.apache.spark.sql.avro.AvroFileFormat",
}

# An error of one partition of a copy; without a partition, of all of them.
ROOT_ERROR = StructType([
    StructField("db", StringType()),
    StructField("table", StringType()),
    StructField("role", StringType()),
    StructField("partition_date", StringType()),
    StructField("exception", StringType()),
])

# No data column is read, so no schema has to be inferred from a file.
NO_COLUMNS = StructType([StructField("no_data_column", StringType())])

DIRECTORY = StructType([StructField(n, StringType()) for n in ("db", "table", "role", "fmt", "partition_date", "dir")])


@dataclass(frozen=True)
class CopyLocation:
    db: str
    table: str
    role: str
    root: str
    partition_col: str
    fmt: str = "orc"


def reader_format(fmt: str) -> str:
    return READER_FORMATS.get(fmt.lower(), fmt)


# Characters Hive-style partition directory names escape as %XX.
HIVE_ESCAPED = '"#%\'*/:=?\\\x7f{[]^'
# Characters that are special in a Hadoop glob.
GLOB_SPECIAL = "\\{}[]*?,"


def hive_escape(value: str) -> str:
    """A partition value as it appears in its directory name."""
    return "".join(f"%{ord(c):02X}" if c in HIVE_ESCAPED or ord(c) < 0x20 else c for c in value)


def glob_escape(text: str) -> str:
    return "".join("\\" + c if c in GLOB_SPECIAL else c for c in text)


def partition_dirs(spark: SparkSession, locations: list[CopyLocation], wanted=None) -> tuple[DataFrame, DataFrame]:
    """``(directories, errors)``: the partition directories to look at, whether they exist or not.

    ``wanted``: a list of partition values for every copy, or a DataFrame ``(table[, db], partition_date)``. ``None``: all
    that exist; then an error row is a root that cannot be listed.
    """
    default = default_store(spark)
    copies = spark.createDataFrame(
        [(*astuple(loc)[:3], qualified(loc.root, default), loc.partition_col, loc.fmt.lower()) for loc in locations],
        "db string, `table` string, role string, root string, partition_col string, fmt string")
    if wanted is None:
        found = _all_partitions(copies)
        errors = found.where("exception IS NOT NULL").select(*ROOT_ERROR.names)
        return found.where("exception IS NULL").select(*DIRECTORY.names), errors
    if isinstance(wanted, DataFrame):
        keys = [k for k in ("db", "table") if k in wanted.columns]
        work = copies.join(wanted.select(*keys, "partition_date").distinct(), keys)
    else:
        work = copies.withColumn("partition_date", F.explode(F.lit(list(dict.fromkeys(wanted))).cast("array<string>")))
    named = F.concat_ws("/", "root", F.concat("partition_col", F.lit("="), _escaped("partition_date")))
    return work.where("partition_date IS NOT NULL").select(*DIRECTORY.names[:-1], named.alias("dir")), \
        spark.createDataFrame([], ROOT_ERROR)


def _escaped(column: str) -> Column:
    """``hive_escape`` as an expression: the characters one after the other, ``%`` first."""
    out = F.col(column)
    for c in sorted(HIVE_ESCAPED, key=lambda c: c != "%") + [chr(i) for i in range(1, 0x20)]:
        out = F.replace(out, F.lit(c), F.lit(f"%{ord(c):02X}"))
    return F.when(F.col(column).rlike("[" + re.escape(HIVE_ESCAPED) + r"\x00-\x1f]"), out).otherwise(F.col(column))


def _all_partitions(copies: DataFrame) -> DataFrame:
    """Every partition of each root: ``DIRECTORY`` columns and ``exception``."""
    out = StructType([*DIRECTORY.fields, StructField("exception", StringType())])
    types = arrow_schema(out)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield as_batch([(db, table, role, fmt, value, None if value is None else f"{root}/{col}={hive_escape(value)}", error)
                            for db, table, role, fmt, col, root in rows_of(batch)
                            for value, error in child_directories(root, col)], types)

    return spread(copies.select("db", "table", "role", "fmt", "partition_col", "root")).mapInArrow(run, out)


def _footer_records(fmt: str, source) -> int:
    return pa.orc.ORCFile(source).nrows if fmt == "orc" else pa.parquet.read_metadata(source).num_rows


FOOTERS = ("orc", "parquet")


def count_in_tasks(fmt: str, path: str | None, length: int | None, footers=FOOTERS) -> tuple[int | None, str | None]:
    """``(records, exception)`` of a file; ``(None, None)`` if its format or its store needs Spark's reader."""
    if path is None or not length:
        return length, None
    if fmt not in footers or not by_tasks(path):
        return None, None
    try:
        store, at = open_store(path)
        with store.open_input_file(at) as source:
            return _footer_records(fmt, source), None
    except Exception as err:  # noqa: BLE001 - a file that cannot be read is an error row of its partition
        return None, f"Error reading file: {path}: {_first_line(err)}"


COUNTED = "path string, length long, modified long, records long"


def known_counts(spark: SparkSession, counted: str | None) -> DataFrame:
    """``(path, length, modified, known)`` of the files that earlier runs have counted."""
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(counted) if counted else None
    there = at is not None and at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(at)
    rows = spark.read.schema(COUNTED).parquet(counted) if there else spark.createDataFrame([], COUNTED)
    return rows.groupBy("path", "length", "modified").agg(F.max("records").alias("known"))


def with_records(files: DataFrame) -> DataFrame:
    """Adds ``records`` to listed files (with ``known`` counts), and the ``exception`` of files that cannot be read."""
    names = [f.name for f in files.schema]
    out = StructType([*files.schema.fields, StructField("records", LongType())])
    types = arrow_schema(out)
    fmt, path, length, exception, known = (names.index(c) for c in ("fmt", "path", "length", "exception", "known"))
    footers = FOOTERS

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with ThreadPoolExecutor(LOOKUP_THREADS) as pool:
            for batch in batches:
                rows = rows_of(batch)
                counted = pool.map(lambda r: (r[known], None) if r[known] is not None
                                   else count_in_tasks(r[fmt], r[path], r[length], footers), rows)
                yield as_batch([(*r[:exception], r[exception] or error, *r[exception + 1:], n)
                                for r, (n, error) in zip(rows, counted, strict=True)], types)

    return spread(files, "path", "dir").mapInArrow(run, out)


def _plain_path() -> Column:
    """The path of a record's file as an inventory spells it: decoded, ``file:/x`` for local files."""
    raw = F.regexp_replace("raw", "^([A-Za-z][A-Za-z0-9+.-]*):///", "$1:/")
    return F.url_decode(F.replace(raw, F.lit("+"), F.lit("%2B")))


def _counts_by_reader(spark: SparkSession, fmt: str, dirs: list[str]) -> DataFrame:
    """``(path, n)``: records per file, counted by Spark's reader without any column; paths are rewritten per file."""
    records = spark.read.format(reader_format(fmt)).schema(NO_COLUMNS).option("recursiveFileLookup", "true") \
        .load([glob_escape(d) for d in dirs])
    return records.groupBy(F.col("_metadata.file_path").alias("raw")).agg(F.count(F.lit(1)).alias("n")) \
        .select(_plain_path().alias("path"), "n")


def _read_by_spark(spark: SparkSession, fmt: str, dirs: list[str]) -> tuple[list[DataFrame], list[tuple[str, str]]]:
    """Counts of all directories of one format, and ``(directory, error)`` of those that cannot be read.

    One job. If a file cannot be read, its directory is set aside and the rest is counted in two halves.
    """
    good, bad, waiting = [], [], [dirs] if dirs else []
    while waiting:
        part = waiting.pop()
        try:
            good.append(_counts_by_reader(spark, fmt, part).checkpoint(eager=True))
        except Exception as err:  # noqa: BLE001 - anything but a read error is raised again
            named = unreadable(err, part)
            if named is None:
                raise
            named = named or (part if len(part) == 1 else [])
            bad += [(d, _first_line(err)) for d in named]
            left = [d for d in part if d not in named]
            waiting += [half for half in (left[:len(left) // 2], left[len(left) // 2:]) if half]
    return good, bad


# Error conditions of a file that cannot be read, and how the message names the file.
READ_ERRORS = ("FAILED_READ_FILE", "CANNOT_READ_FILE_FOOTER", "MALFORMED_ORC", "MALFORMED_AVRO")
NAMED_FILE = re.compile(r"(?:reading file|footer for file:?)\s+'?([^\s']+?)'?\.?(?:\s|$)")


def unreadable(err: Exception, dirs: list[str]) -> list[str] | None:
    """The directories of the file that a read error names, none if it names none; ``None`` for any other error."""
    text = str(err)
    if not any(condition in text for condition in READ_ERRORS):
        return None
    named = NAMED_FILE.search(text)
    if not named:
        return []
    from urllib.parse import unquote
    at = re.sub(r"^([A-Za-z][A-Za-z0-9+.-]*):///", r"\1:/", named[1])
    return [d for d in dirs if at.startswith(d + "/") or unquote(at).startswith(d + "/")]


def copy_files(spark: SparkSession, locations: list[CopyLocation], wanted=None,
               counted: str | None = None) -> tuple[DataFrame, DataFrame]:
    """``(files, errors)``: the files of all copies with their records, kept in the shared checkpoint folder."""
    checkpoint_root(spark)
    directories, root_errors = partition_dirs(spark, locations, wanted)
    found = listed(directories)
    found = found.join(known_counts(spark, counted), ["path", "length", "modified"], "left") if counted else \
        found.withColumn("known", F.lit(None).cast("long"))
    files = with_records(found.select(*DIRECTORY.names, "path", "length", "modified", "exception", "known")).checkpoint(eager=True)
    by_format: dict[str, list[str]] = {}
    default = default_store(spark)
    if any(loc.fmt.lower() not in FOOTERS or not by_tasks(qualified(loc.root, default)) for loc in locations):
        uncounted = files.where("records IS NULL AND path IS NOT NULL AND exception IS NULL")
        for fmt, directory in sorted(uncounted.select("fmt", "dir").distinct().collect()):
            by_format.setdefault(fmt, []).append(directory)
    counts, bad = [], []
    for fmt, dirs in by_format.items():
        good, failed = _read_by_spark(spark, fmt, dirs)
        counts += good
        bad += failed
    if by_format:
        found = union_all(counts) if counts else spark.createDataFrame([], "path string, n long")
        errors = spark.createDataFrame(bad, "dir string, failed string")
        files = files.join(found, "path", "left").join(errors, "dir", "left").select(
            *[c for c in files.columns if c not in ("records", "exception")],
            F.coalesce("exception", "failed").alias("exception"), F.coalesce("records", "n", F.lit(0)).alias("records"))
    if counted:
        files.where("known IS NULL AND path IS NOT NULL AND exception IS NULL") \
            .select("path", "length", "modified", "records").distinct().write.mode("append").parquet(counted)
    return files, root_errors


def scan_copies(spark: SparkSession, locations: list[CopyLocation], wanted=None,
                counted: str | None = None) -> tuple[DataFrame, DataFrame]:
    """``(stats rows, errors)`` of all copies, one stats row per file.

    A partition with an error row has no stats rows. ``counted``: a folder of counts per file that runs share.
    """
    files, root_errors = copy_files(spark, locations, wanted, counted)
    keys = ["db", "table", "role", "partition_date"]
    errors = files.where("exception IS NOT NULL").groupBy(*keys).agg(F.min("exception").alias("exception"))
    stats = files.where("path IS NOT NULL").join(errors, keys, "left_anti").select(
        *keys, F.coalesce("records", F.lit(0)).cast("long").alias("records"), F.lit(1).cast("long").alias("files"),
        F.col("length").cast("long").alias("bytes"))
    return stats, root_errors.unionByName(errors)


def union_all(frames: list[DataFrame]) -> DataFrame:
    """Union by name as a balanced tree: log-depth plan, and each step analyses
    a small plan (a left-deep chain re-analyses the growing plan every time)."""
    frames = list(frames)
    while len(frames) > 1:
        frames = [frames[i].unionByName(frames[i + 1]) if i + 1 < len(frames) else frames[i]
                  for i in range(0, len(frames), 2)]
    return frames[0]


def copy_counts(stats_rows: DataFrame) -> DataFrame:
    """A1-A3: records, files and bytes per (db, table, role, partition)."""
    return (stats_rows.groupBy("db", "table", "role", "partition_date")
            .agg(F.sum("records").alias("records"),
                 F.sum("files").alias("files"),
                 F.sum("bytes").alias("bytes")))
