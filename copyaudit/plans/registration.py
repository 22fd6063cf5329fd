"""Partition registration.

Statement batches arrive as strings; splitting, normalising and naming the
table are column expressions over any number of batches. Executing DDL is a
catalog call, which Spark only makes on the driver: the statements are
streamed there with ``toLocalIterator`` (one partition at a time, never the
whole list at once), dealt to lanes by table (in order within a table, tables
at the same time), grouped into multi-spec statements per table, and each
outcome is logged in the shared folder before the next call of its lane. Only
``ALTER TABLE ... ADD [IF NOT EXISTS] PARTITION`` is executed; anything else
is refused as a failure row without being run.
"""

from __future__ import annotations

import json
import re
import uuid
import zlib
from concurrent.futures import ThreadPoolExecutor
from queue import Queue

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from copyaudit.functions import messages, paths, statements
from copyaudit.session import scratch_path
from copyaudit.sources.arguments import statement_rows

OUTCOME_SCHEMA = ("batch_id string, ordinal int, statement string, statement_table string, "
                  "outcome string, exception string")


def split_statements(batches: DataFrame, batch_col: str = "batch") -> DataFrame:
    """S10 + P17 + P18: one normalised statement per row, empty pieces dropped."""
    rows = statement_rows(batches, batch_col)
    return (rows.withColumn("statement", statements.normalise_statement("raw_statement"))
            .where(F.col("statement") != "")
            .withColumn("statement_table", statements.statement_table("statement"))
            .withColumn("allowed", statements.is_add_partition("statement"))
            .drop("raw_statement"))


# "ALTER TABLE <t> ADD [IF NOT EXISTS] <one or more partition clauses>"
_ADD = re.compile(r"^ALTER\s+TABLE\s+(\S+)\s+ADD\s+(IF\s+NOT\s+EXISTS\s+)?(PARTITION\b.+)$", re.IGNORECASE | re.DOTALL)
# A quoted value, in which brackets, commas and keywords mean nothing.
_QUOTED = r"""'(?:[^'\\]|\\.)*'|"(?:[^"\\]|\\.)*\""""
_CLAUSE = re.compile(rf"""PARTITION\s*\(((?:{_QUOTED}|[^)'"])*)\)(?:\s*LOCATION\s*(?:{_QUOTED}))?""", re.IGNORECASE)
_PAIR = re.compile(rf"""`?([A-Za-z_][A-Za-z0-9_]*)`?\s*=\s*({_QUOTED}|[^,\s'"]+)""")
REFUSED = "only ALTER TABLE ... ADD PARTITION statements are run"
CHUNK_SIZE = 100
LANES = 8
WAITING = 1_000         # statements that wait for a lane


def partition_clauses(specs: str) -> list[frozenset] | None:
    """The partitions that clauses name, each as a set of (column, value) without quotes and ``LOCATION``.

    ``None`` when the text holds anything but whole clauses.
    """
    clauses = list(_CLAUSE.finditer(specs))
    if not clauses or _CLAUSE.sub("", specs).strip():
        return None

    def bare(value: str) -> str:
        return re.sub(r"\\(.)", r"\1", value[1:-1]) if value[0] in "'\"" else value

    return [frozenset((c.lower(), bare(v)) for c, v in _PAIR.findall(m[1])) for m in clauses]


def _first_line(err: Exception) -> str:
    text = str(err)
    return text.splitlines()[0] if text else repr(err)


class OutcomeLog:
    """What has been run, as small files of one folder: a file before each call, and one after it with the outcomes."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        self.jvm, self.conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()

    def _at(self, name: str):
        at = self.jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}".rstrip("/"))
        return at.getFileSystem(self.conf), at

    def write(self, kind: str, name: str, rows: list[dict]) -> None:
        store, draft = self._at(f"{kind}/_{name}")
        out = store.create(draft, True)
        out.write("".join(json.dumps(r) + "\n" for r in rows).encode())
        out.close()
        if not store.rename(draft, self._at(f"{kind}/{name}.json")[1]):
            raise OSError(f"cannot write {self.path}/{kind}/{name}.json")

    def remove(self) -> None:
        store, at = self._at("")
        store.delete(at, True)

    def read(self, kind: str) -> DataFrame:
        store, at = self._at(kind)
        if not store.exists(at):
            return self.spark.createDataFrame([], OUTCOME_SCHEMA + ", call string")
        return self.spark.read.schema(OUTCOME_SCHEMA + ", call string").json(f"{self.path}/{kind}")


class Lane:
    """Runs the statements of its tables in order; consecutive ones that fit become one call.

    A failing call of at most ``chunk_size`` partition clauses adds nothing, so it is split in halves and retried until
    each failing statement stands alone. A partition that was named before in the chunk (its columns and values, whatever
    the quotes, order or ``LOCATION``) starts a new one, and statements for unknown tables or with other keys than the
    table's partition columns (looked up once per table) run on their own.
    """

    def __init__(self, spark: SparkSession, log: OutcomeLog, id_col: str, chunk_size: int):
        self.spark, self.log, self.id_col, self.chunk_size = spark, log, id_col, chunk_size
        self.pending: list[tuple] = []        # (row, table, if_not_exists, clauses as text)
        self.seen: set[frozenset] = set()     # partitions named in the pending chunk
        self.partition_cols: dict[str, set | None] = {}
        self.waiting: Queue = Queue(maxsize=WAITING)

    def work(self) -> None:
        """Until a ``None`` comes; after an error of the log or the session, only empties the queue, then raises it."""
        failed = None
        while (row := self.waiting.get()) is not None:
            if failed is None:
                try:
                    self.take(row)
                except BaseException as err:  # noqa: BLE001 - raised below, once the producer is through
                    failed = err
        if failed is not None:
            raise failed
        self.flush()

    def fits(self, table: str, clauses: list[frozenset] | None) -> bool:
        """The table exists and every clause names exactly its partition columns."""
        if table not in self.partition_cols:
            try:
                self.partition_cols[table] = {c.name.lower() for c in self.spark.catalog.listColumns(table) if c.isPartition}
            except Exception:  # noqa: BLE001 - unknown table: its statements run (and fail) alone
                self.partition_cols[table] = None
        cols = self.partition_cols[table]
        return bool(cols) and clauses is not None and len(set(clauses)) == len(clauses) <= self.chunk_size and all(
            len(c) == len(cols) and {k for k, _ in c} == cols for c in clauses)

    def take(self, row) -> None:
        m = _ADD.match(row["statement"]) if row["allowed"] and not row["uncertain"] else None
        clauses = partition_clauses(m.group(3).strip()) if m else None
        if m is None or not self.fits(m.group(1), clauses):
            self.flush()
            self.call([row], lambda: self.run_one(row))
            return
        table, ine, spec = m.group(1), bool(m.group(2)), m.group(3).strip()
        if self.pending and ((table.lower(), ine) != (self.pending[0][1].lower(), self.pending[0][2])
                             or len(self.seen) + len(clauses) > self.chunk_size or not self.seen.isdisjoint(clauses)):
            self.flush()
        self.pending.append((row, table, ine, spec))
        self.seen.update(clauses)

    def flush(self) -> None:
        group = list(self.pending)
        self.pending.clear()
        self.seen.clear()
        if group:
            self.call([row for row, *_ in group], lambda: self.run_group(group))

    def call(self, rows: list, run) -> None:
        name = uuid.uuid4().hex
        named = [{"batch_id": r[self.id_col], "ordinal": r["ordinal"], "statement": r["statement"],
                  "statement_table": r["statement_table"], "call": name} for r in rows]
        self.log.write("begun", name, named)
        self.log.write("done", name, [n | {"outcome": outcome, "exception": exception}
                                      for n, (outcome, exception) in zip(named, run(), strict=True)])

    def run_one(self, row) -> list[tuple]:
        if not row["allowed"]:
            return [("refused", REFUSED)]
        statement = row["statement"]
        if row["uncertain"]:                                      # begun by a run that was killed: it may be there
            statement = re.sub(r"(?i)^(ALTER\s+TABLE\s+\S+\s+ADD)\s+(IF\s+NOT\s+EXISTS\s+)?", r"\1 IF NOT EXISTS ", statement)
        try:
            self.spark.sql(statement)
        except Exception as err:  # noqa: BLE001 - every failure becomes a row, the batch goes on
            return [("failed", _first_line(err))]
        return [("ok", None)]

    def run_group(self, group) -> list[tuple]:
        if len(group) == 1:
            return self.run_one(group[0][0])
        _, table, ine, _ = group[0]
        combined = f"ALTER TABLE {table} ADD {'IF NOT EXISTS ' if ine else ''}" + \
            " ".join(spec for _, _, _, spec in group)
        try:
            self.spark.sql(combined)
        except Exception:  # noqa: BLE001 - nothing was added; bisect to find the failing ones
            mid = len(group) // 2
            return self.run_group(group[:mid]) + self.run_group(group[mid:])
        return [("ok", None)] * len(group)


def apply_statements(spark: SparkSession, stmts: DataFrame, id_col: str = "batch_id", chunk_size: int = CHUNK_SIZE,
                     lanes: int = LANES, log: str | None = None) -> DataFrame:
    """Run each allowed statement; one outcome row per statement.

    Consecutive statements that add partitions to the same table are sent as
    one multi-spec ``ALTER TABLE t ADD PARTITION (..) PARTITION (..)`` (see
    ``Lane``), so one bad statement among n costs about 2*log2(n) extra calls.
    Tables are dealt to ``lanes`` threads by name: outcomes are those of one
    statement after the other, as statements of different tables do not meet.

    ``log``: the folder of the outcomes. A run with the folder of one that was
    killed goes on where that stopped: statements with an outcome there are not
    run again, and those of calls that were begun and not ended are run with
    ``IF NOT EXISTS``, as they may have been added. Without it, a new folder.
    """
    folder = OutcomeLog(spark, log or scratch_path(spark, "registration-outcomes"))
    keys = ["batch_id", "ordinal", "statement"]
    done, begun = (folder.read(kind).select(*keys).distinct() for kind in ("done", "begun"))
    todo = stmts.withColumn("batch_id", F.col(id_col).cast("string"))

    def same(other: DataFrame):
        return [todo[k].eqNullSafe(other[k]) for k in keys]

    uncertain = begun.join(done, [begun[k].eqNullSafe(done[k]) for k in keys], "left_anti").withColumn("uncertain", F.lit(True))
    ordered = todo.join(done, same(done), "left_anti").join(uncertain, same(uncertain), "left").select(
        todo[id_col], todo["ordinal"], todo["statement"], todo["statement_table"], todo["allowed"],
        F.coalesce("uncertain", F.lit(False)).alias("uncertain")).orderBy(id_col, "ordinal")
    crew = [Lane(spark, folder, id_col, chunk_size) for _ in range(max(1, lanes))]
    with ThreadPoolExecutor(len(crew)) as pool:
        ends = [pool.submit(lane.work) for lane in crew]
        try:
            for row in ordered.toLocalIterator():
                crew[zlib.crc32(row["statement_table"].lower().encode()) % len(crew)].waiting.put(row)
        finally:
            for lane in crew:
                lane.waiting.put(None)
        for end in ends:
            end.result()
    outcomes = folder.read("done").drop("call")
    return outcomes if id_col == "batch_id" else outcomes.withColumnRenamed("batch_id", id_col)


def registration_failures(outcomes: DataFrame, src_system: str, country: str, status_dir: str,
                          partition: str | None = None) -> DataFrame:
    """Failure rows with the original message and failure file name.

    ``partition`` defaults to each statement's batch id.
    """
    part = F.lit(partition) if partition is not None else F.col("batch_id")
    failed = outcomes.where(F.col("outcome") != "ok")
    return failed.select(
        F.lit("PartitionUpdate").alias("stage"),
        F.lit(None).cast("string").alias("db"),
        F.col("statement_table").alias("table"),
        part.alias("partition_date"),
        messages.registration_failure(F.lit(src_system), F.lit(country), "statement_table").alias("message"),
        F.col("exception"),
        F.col("ordinal").cast("int").alias("ordinal"),
        paths.file_name(paths.registration_failure_path(F.lit(status_dir), F.lit(src_system), F.lit(country),
                                                        "statement_table", part)).alias("failure_file"))
