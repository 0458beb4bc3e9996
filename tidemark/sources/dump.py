"""Dump text as statements, and the schema and position that it starts from."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions import text as X


@dataclass
class Scope:
    """What a dump covers: all databases, some, or tables of one (adding tables of another replaces them); tables to pass over; a row predicate."""

    databases: list[str] = field(default_factory=list)
    table_db: str = ""
    tables: list[str] = field(default_factory=list)
    ignored: list[tuple[str, str]] = field(default_factory=list)
    where: str = ""

    def add_tables(self, database: str, *tables: str) -> None:
        self.tables = [*(self.tables if database == self.table_db else []), *tables]
        self.table_db = database

    def ignore(self, *names: str) -> None:
        """Names as ``database.table``."""
        self.ignored += [tuple(n.split(".", 1)) for n in names]

    def covers(self, rows: DataFrame) -> DataFrame:
        """Of rows (database, table, ..) those in scope."""
        if self.tables:
            rows = rows.where((F.col("database") == self.table_db) & F.col("table").isin(*self.tables))
        elif self.databases:
            rows = rows.where(F.col("database").isin(*self.databases))
        for database, table in self.ignored:
            rows = rows.where(~((F.col("database") == database) & (F.col("table") == table)))
        return rows.where(self.where) if self.where else rows


def statements(lines: Iterator[str]) -> Iterator[str]:
    """Lines joined without a separator up to one that ends in a semicolon; an unfinished last statement is dropped."""
    held: list[str] = []
    for line in lines:
        held.append(line.rstrip("\r\n"))
        if held[-1].endswith(";"):
            yield "".join(held)
            held = []


def read_statements(spark: SparkSession, path: str) -> DataFrame:
    """(file, n, statement) of dump files; a file is read by one task, as its statements run across lines."""

    def rows(batches):
        import io

        import pyarrow as pa

        for b in batches:
            for name, content in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                held: list[str] = []
                n = 0
                for s in statements(io.TextIOWrapper(io.BytesIO(content), "utf-8", "replace", newline="\n")):
                    held.append(s)
                    if len(held) == 1000:
                        yield pa.RecordBatch.from_arrays([pa.array([name] * len(held)), pa.array(range(n, n + len(held)), pa.int64()), pa.array(held)], names=["file", "n", "statement"])
                        n, held = n + len(held), []
                if held:
                    yield pa.RecordBatch.from_arrays([pa.array([name] * len(held)), pa.array(range(n, n + len(held)), pa.int64()), pa.array(held)], names=["file", "n", "statement"])

    return spark.read.format("binaryFile").load(path).select("path", "content").mapInArrow(rows, "file string, n long, statement string")


def parsed(lines: DataFrame) -> DataFrame:
    """lines (.., statement) with what each says: position, GTID, database, CREATE, table and values."""
    s = F.col("statement")
    name, pos = X.dump_position(s)
    table, values = X.dump_insert(s)
    return lines.select("*", name.alias("binlog_name"), pos.alias("binlog_pos"), X.dump_gtid(s).alias("gtid"), X.dump_database(s).alias("use_db"), X.is_create(s).alias("is_create"), table.alias("table"), values.alias("values"))
