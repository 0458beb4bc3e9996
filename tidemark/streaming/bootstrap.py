"""Start of an engine: the schema from a dump or from the history, and the position to go on from."""

from __future__ import annotations

import json
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.schemas import ColumnDef, Mirror, TableDef, latest, retained
from tidemark.plans.model import SCHEMA_HISTORY
from tidemark.sources.dump import parsed
from tidemark.streaming.sinks import snapshot


def from_dump(statements: DataFrame, mirror: Mirror, gtid_enabled: bool = False) -> dict:
    """Applies a schema-only dump (rows n, statement) to the mirror, in order; the position it was taken at, first match of each kind.

    Data rows are passed over. With GTIDs enabled a dump without a set is an error; without a position the caller asks the server for
    one, which may be later than the dump.
    """
    at: dict = {"log_name": "", "log_pos": 0, "gset": None}
    database = ""
    wanted = parsed(statements).where("binlog_name is not null or gtid is not null or use_db is not null or is_create")
    for r in wanted.orderBy("n").toLocalIterator():  # schema statements only
        if r.binlog_name and not at["log_name"]:
            at |= {"log_name": r.binlog_name, "log_pos": r.binlog_pos}
        if r.gtid and at["gset"] is None:
            at["gset"] = r.gtid
        if r.use_db:
            database = r.use_db
        if r.is_create:
            mirror.apply(r.statement, database)
    if gtid_enabled and not at["gset"]:
        raise ValueError("the dump has no GTID set")
    return at


def restored(text: str) -> Mirror:
    """The mirror from a snapshot's text."""
    m = Mirror()
    for database, name, columns in json.loads(text):
        m.tables[database.lower(), name.lower()] = TableDef(database, name, tuple(ColumnDef(*c) for c in columns))
        m.databases.add(database.lower())
    return m


class History:
    """Snapshots of the mirror as an append-only table; the last one is what a restart begins with."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark, self.path = spark, path

    def reset(self) -> None:
        self.spark.createDataFrame([], SCHEMA_HISTORY).write.mode("overwrite").parquet(self.path)

    def exists(self) -> bool:
        at = self.spark._jvm.org.apache.hadoop.fs.Path(self.path)
        return at.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(at)

    def rows(self) -> DataFrame:
        return self.spark.read.schema(SCHEMA_HISTORY).parquet(self.path)

    def save(self, mirror: Mirror, log_name: str, log_pos: int, db: str, statement: str) -> bool:
        """False if the last record is of this position: the change was applied already."""
        last = latest(self.rows()).first()
        if last is not None and (last.log_name, last.log_pos) == (log_name, log_pos):
            return False
        seq = 1 if last is None else last.seq + 1
        self.spark.createDataFrame([(seq, log_name, log_pos, snapshot(mirror), db, statement, datetime.now(timezone.utc))], SCHEMA_HISTORY).coalesce(1).write.mode("append").parquet(self.path)
        return True

    def last(self) -> Mirror | None:
        row = latest(self.rows()).first()
        return None if row is None else restored(row.snapshot)

    def kept(self) -> DataFrame:
        """What retention keeps: the last record, and those under seven days old."""
        return retained(self.rows(), F.current_timestamp())


def first_position(progress: dict | None, dump: DataFrame | None, mirror: Mirror, gtid_enabled: bool = False) -> dict:
    """Where to start: the sinks' least progress if there is any; else the dump's, after its schema; without either, the log's start."""
    if progress:
        return progress
    if dump is None:
        return {"server_id": 0, "log_name": "", "log_pos": 0, "gset": None}
    return {"server_id": 0, **from_dump(dump, mirror, gtid_enabled)}
