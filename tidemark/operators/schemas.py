"""The schema mirror: a fold over schema changes, its history, and its binding to row events."""

from __future__ import annotations

import re
from collections.abc import Iterable
from dataclasses import dataclass, field, replace

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


@dataclass(frozen=True)
class ColumnDef:
    name: str
    sql_type: str
    key: str = ""
    charset: str = ""
    unsigned: bool = False
    nullable: bool = True


@dataclass(frozen=True)
class TableDef:
    database: str
    name: str
    columns: tuple[ColumnDef, ...] = ()
    charset: str = "utf8"


#: Definition of a table that high-availability tools write and no dump has.
HEALTH_CHECK = TableDef("mysql", "ha_health_check", (ColumnDef("id", "bigint", "PRI"), ColumnDef("type", "char(1)")))
_NAME = r"(?:`((?:[^`]|``)+)`|([\w$]+))"
_TABLE = rf"{_NAME}(?:\s*\.\s*{_NAME})?"


class UnknownStatement(ValueError):
    """A schema change that the mirror can't follow."""


def _split(text: str) -> list[str]:
    """At commas outside parentheses and quotes."""
    out, depth, quote, start = [], 0, "", 0
    for i, c in enumerate(text):
        if quote:
            quote = "" if c == quote else quote
        elif c in "'\"`":
            quote = c
        elif c in "()":
            depth += 1 if c == "(" else -1
        elif c == "," and not depth:
            out.append(text[start:i].strip())
            start = i + 1
    return [*out, text[start:].strip()]


@dataclass
class Mirror:
    """Tables by (database, name), both in lower case. ``apply`` leaves the mirror as it was if a statement fails."""

    tables: dict[tuple[str, str], TableDef] = field(default_factory=dict)
    databases: set[str] = field(default_factory=set)
    charset: str = "utf8"

    def table(self, database: str, name: str) -> TableDef:
        found = self.tables.get((database.lower(), name.lower()))
        if found is None and (database.lower(), name.lower()) == (HEALTH_CHECK.database, HEALTH_CHECK.name):
            return HEALTH_CHECK
        if found is None:
            raise KeyError(f"no table {database}.{name}")
        return found

    def apply(self, statement: str, database: str = "") -> None:
        before = dict(self.tables), set(self.databases)
        try:
            self._apply(re.sub(r"\s+", " ", re.sub(r"/\*.*?\*/|--[^\n]*", " ", statement, flags=re.S)).strip().rstrip(";"), database)
        except Exception:
            self.tables, self.databases = before
            raise

    def _key(self, m: re.Match, at: int, database: str) -> tuple[str, str]:
        a, b = m[at] or m[at + 1], m[at + 2] or m[at + 3]
        return ((a, b) if b else (database, a))[0].lower(), (b or a).lower()

    def _apply(self, s: str, database: str) -> None:
        match = lambda p: re.match(p, s, re.I)
        if m := match(rf"(CREATE|DROP) (?:DATABASE|SCHEMA) (?:IF (?:NOT )?EXISTS )?{_NAME}"):
            name = (m[2] or m[3]).lower()
            if m[1].upper() == "CREATE":
                self.databases.add(name)
            else:
                self.databases.discard(name)
                self.tables = {k: v for k, v in self.tables.items() if k[0] != name}
        elif m := match(rf"CREATE TABLE (IF NOT EXISTS )?{_TABLE} ?\(? ?LIKE {_TABLE}"):
            new, old = self._key(m, 2, database), self._key(m, 6, database)
            self._create(new, replace(self.table(*old), database=new[0], name=new[1]), bool(m[1]))
        elif m := match(rf"CREATE TABLE (IF NOT EXISTS )?{_TABLE} ?\((.*)\)([^)]*)$"):
            key = self._key(m, 2, database)
            columns: list[ColumnDef] = []
            for part in _split(m[6]):
                self._part(columns, part)
            charset = re.search(r"CHARSET ?=? ?(\w+)", m[7], re.I)
            self._create(key, TableDef(key[0], key[1], tuple(columns), charset[1] if charset else self.charset), bool(m[1]))
        elif m := match(rf"DROP TABLE (IF EXISTS )?(.+?)( CASCADE| RESTRICT)?$"):
            for part in _split(m[2]):
                key = self._key(re.match(_TABLE, part), 1, database)
                if key not in self.tables and not m[1]:
                    raise KeyError(f"no table {key}")
                self.tables.pop(key, None)
        elif m := match(r"RENAME TABLE (.+)$"):
            for part in _split(m[1]):
                r = re.match(rf"{_TABLE} TO {_TABLE}$", part, re.I)
                if not r:
                    raise UnknownStatement(s)
                self._rename(self._key(r, 1, database), self._key(r, 5, database))
        elif m := match(rf"ALTER TABLE {_TABLE} (.+)$"):
            key = self._key(m, 1, database)
            for part in _split(m[5]):
                key = self._alter(key, part, database)
        elif match(rf"(TRUNCATE|CREATE (UNIQUE )?INDEX|DROP INDEX|CREATE (OR REPLACE )?.*VIEW|DROP VIEW)"):
            pass
        else:
            raise UnknownStatement(s)

    def _create(self, key: tuple[str, str], table: TableDef, quiet: bool) -> None:
        if key in self.tables:
            if quiet:
                return
            raise ValueError(f"table {key} exists")
        self.databases.add(key[0])
        self.tables[key] = table

    def _rename(self, old: tuple[str, str], new: tuple[str, str]) -> None:
        if new in self.tables:
            raise ValueError(f"table {new} exists")
        self.tables[new] = replace(self.table(*old), database=new[0], name=new[1])
        del self.tables[old]

    @staticmethod
    def _column(text: str) -> tuple[ColumnDef, str]:
        m = re.match(rf"{_NAME} (\w+(?: ?\([^)]*\))?(?: unsigned)?)(.*)$", text, re.I)
        if not m:
            raise UnknownStatement(text)
        rest = m[4]
        key = "PRI" if re.search(r"PRIMARY KEY", rest, re.I) else "UNI" if re.search(r"\bUNIQUE\b", rest, re.I) else ""
        charset = re.search(r"CHARACTER SET (\w+)|CHARSET (\w+)", rest, re.I)
        c = ColumnDef(m[1] or m[2], m[3].lower(), key, (charset[1] or charset[2]) if charset else "", "unsigned" in m[3].lower(), not key == "PRI" and not re.search("NOT NULL", rest, re.I))
        return c, rest

    def _part(self, columns: list[ColumnDef], text: str) -> None:
        """A column of CREATE TABLE, or a key over earlier columns."""
        if m := re.match(rf"(PRIMARY KEY|UNIQUE(?: KEY| INDEX)?|KEY|INDEX|FULLTEXT(?: KEY)?|SPATIAL(?: KEY)?|CONSTRAINT .*?KEY|FOREIGN KEY)\b[^(]*\(([^)]*(?:\(\d+\)[^)]*)*)\)", text, re.I):
            kind = "PRI" if "PRIMARY" in m[1].upper() else "UNI" if "UNIQUE" in m[1].upper() else "MUL"
            names = [re.match(_NAME, p)[1] or re.match(_NAME, p)[2] for p in _split(m[2])]
            for i, c in enumerate(columns):
                if kind == "PRI" and c.name in names or names[:1] == [c.name]:
                    own = kind if kind == "PRI" or len(names) == 1 else "MUL"
                    if not c.key or own == "PRI":
                        columns[i] = replace(c, key=own, nullable=c.nullable and own != "PRI")
        else:
            columns.append(self._column(text)[0])

    def _alter(self, key: tuple[str, str], text: str, database: str) -> tuple[str, str]:
        table = self.table(*key)
        columns = list(table.columns)
        place = lambda name: next((i for i, c in enumerate(columns) if c.name.lower() == name.lower()), None)

        def put(c: ColumnDef, rest: str, at: int) -> None:
            if re.search(r"\bFIRST$", rest, re.I):
                at = 0
            elif m := re.search(rf"\bAFTER {_NAME}$", rest, re.I):
                at = place(m[1] or m[2]) + 1
            columns.insert(at, c)

        if m := re.match(rf"RENAME (?:TO |AS )?(?!COLUMN|INDEX|KEY){_TABLE}$", text, re.I):
            new = self._key(m, 1, key[0])
            self._rename(key, new)
            return new
        if m := re.match(rf"RENAME COLUMN {_NAME} TO {_NAME}$", text, re.I):
            i = place(m[1] or m[2])
            columns[i] = replace(columns[i], name=m[3] or m[4])
        elif m := re.match(r"ADD (?:PRIMARY KEY|UNIQUE|KEY|INDEX|CONSTRAINT|FULLTEXT|SPATIAL|FOREIGN)", text, re.I):
            self._part(columns, text[4:])
        elif m := re.match(r"ADD (?:COLUMN )?(?:IF NOT EXISTS )?\((.*)\)$", text, re.I):
            columns += [self._column(p)[0] for p in _split(m[1])]
        elif m := re.match(r"ADD (?:COLUMN )?(.*)$", text, re.I):
            c, rest = self._column(m[1])
            if place(c.name) is not None:
                raise ValueError(f"column {c.name} exists")
            put(c, rest, len(columns))
        elif re.match(r"DROP (?:PRIMARY KEY|KEY|INDEX|FOREIGN KEY|CONSTRAINT)", text, re.I):
            if re.match("DROP PRIMARY", text, re.I):
                columns = [replace(c, key="" if c.key == "PRI" else c.key) for c in columns]
        elif m := re.match(rf"DROP (?:COLUMN )?{_NAME}$", text, re.I):
            del columns[place(m[1] or m[2])]
        elif m := re.match(r"MODIFY (?:COLUMN )?(.*)$", text, re.I):
            c, rest = self._column(m[1])
            i = place(c.name)
            put(replace(c, key=c.key or columns.pop(i).key), rest, i) if not c.key else (columns.pop(i), put(c, rest, i))
        elif m := re.match(rf"CHANGE (?:COLUMN )?{_NAME} (.*)$", text, re.I):
            i = place(m[1] or m[2])
            c, rest = self._column(m[3])
            put(replace(c, key=c.key or columns.pop(i).key), rest, i) if not c.key else (columns.pop(i), put(c, rest, i))
        elif not re.match(r"(ENGINE|AUTO_INCREMENT|COMMENT|DEFAULT|CONVERT|CHARACTER|COLLATE|ALTER|ORDER|ALGORITHM|LOCK|DISABLE|ENABLE|RENAME (INDEX|KEY))\b", text, re.I):
            raise UnknownStatement(text)
        self.tables[key] = replace(table, columns=tuple(columns))
        return key


def folded(statements: Iterable[tuple[int, str, int, str, str]], mirror: Mirror | None = None) -> tuple[list[tuple], list[tuple]]:
    """((seq, log_name, log_pos, db, table, columns) for each table that a statement changed, (seq, statement, reason) of those that failed).

    statements: (seq, log_name, log_pos, current database, text) in order. A statement at the position of the one before was applied
    already. The fold runs on the driver: schema changes are few, and each depends on all before it.
    """
    mirror = mirror or Mirror()
    history, failed, last = [], [], None
    for seq, name, pos, database, text in statements:
        if (name, pos) == last:
            continue
        before = dict(mirror.tables)
        try:
            mirror.apply(text, database)
        except Exception as e:  # goes to the dead letters; the next statement sees the mirror as it was
            failed.append((seq, text, f"{type(e).__name__}: {e}"))
            continue
        last = (name, pos)
        for k in sorted({*before, *mirror.tables}):
            if before.get(k) is not mirror.tables.get(k):
                t = mirror.tables.get(k)
                history.append((seq, name, pos, *k, None if t is None else [(c.name, c.sql_type, c.key) for c in t.columns]))
    return history, failed


def bound(rows: DataFrame, history: DataFrame, block: int = 1 << 16) -> DataFrame:
    """rows with version (the history's seq) of their table that held at their seq; null before the first.

    history is (database, table, seq, version). Its records stand among the rows as markers, and the last one is carried forward within
    a table and block of seq; what a block starts with comes from one row for each. So no row is held against all versions of its table,
    and a busy table is many tasks. A version that is null (a table removed) is carried as such; of records with one seq the greatest
    version holds. Rows without a database or table get null.
    """
    key = ["database", "table", "_tm_b"]
    marks = history.where("database is not null and table is not null").select("database", "table", "seq", F.struct("version").alias("_tm_v"))
    together = rows.withColumn("_tm_row", F.lit(True)).unionByName(marks, allowMissingColumns=True).withColumn("_tm_b", F.floor(F.col("seq") / block))
    is_mark = F.col("_tm_v").isNotNull()
    ends = together.groupBy(*key).agg(F.max(F.when(is_mark, F.struct("seq", "_tm_v"))).alias("_tm_e"))
    earlier = W.partitionBy("database", "table").orderBy("_tm_b").rowsBetween(W.unboundedPreceding, -1)
    starts = ends.select(*key, F.last("_tm_e", ignorenulls=True).over(earlier).getField("_tm_v").alias("_tm_s"))
    # a marker comes before the rows of its own seq
    so_far = W.partitionBy(*key).orderBy("seq", F.col("_tm_row").asc_nulls_first(), "_tm_v").rowsBetween(W.unboundedPreceding, W.currentRow)
    carried = together.withColumn("_tm_l", F.last("_tm_v", ignorenulls=True).over(so_far)).where("_tm_row")
    held = F.coalesce("_tm_l", "_tm_s").getField("version")
    return carried.join(starts, key, "left").select(*rows.columns, held.alias("version"))


def with_fallback(bound_rows: DataFrame, strict: bool = False) -> DataFrame:
    """The health-check table's definition stands in where none is known; any other gap is -1, or an error if strict."""
    known = (F.col("database") == HEALTH_CHECK.database) & (F.col("table") == HEALTH_CHECK.name)
    gap = F.raise_error(F.concat(F.lit("no definition of "), F.concat_ws(".", "database", "table"))).cast("long") if strict else F.lit(-1).cast("long")
    return bound_rows.withColumn("version", F.coalesce("version", F.when(known, F.lit(0).cast("long")).otherwise(gap)))


def latest(history: DataFrame) -> DataFrame:
    return history.orderBy(F.desc("seq")).limit(1)


def retained(history: DataFrame, now, days: int = 7) -> DataFrame:
    """Without records that come before the last and are ``days`` old or more."""
    last = history.agg(F.max("seq").alias("_tm_last"))  # one row
    old = (F.col("seq") < F.col("_tm_last")) & (F.col("ts") <= now - F.expr(f"interval {days} days"))
    return history.crossJoin(F.broadcast(last)).where(~old).drop("_tm_last")


def listing(history: DataFrame) -> DataFrame:
    """(database, table) of tables that the mirror has at the end: those whose last record isn't a removal."""
    last = history.groupBy("database", "table").agg(F.max_by("present", "seq").alias("present"))
    return last.where("present").select("database", "table")
