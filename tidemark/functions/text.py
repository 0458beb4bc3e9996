"""Statement and dump text: normalising, classifying, parsing, value text."""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Patterns of the statement normaliser, in order, with what takes their place; and of statements that count as DDL or DCL.
TRIM = ((r"--[^\n]*\n?", " "), (r"^\s*#[^\n]*\n?", " "), (r"[\r\n]+", " "), (r"/\*.*?\*/", " "), (r"\s+", " "), (r"^\s+", ""))
DDL_OR_DCL = "CREATE DROP ALTER RENAME TRUNCATE GRANT REVOKE FLUSH"
SCHEMA_CHANGES = "CREATE DROP ALTER RENAME TRUNCATE"


def normalised(statement: Column) -> Column:
    """Comments go, white space is one space, letters are upper case."""
    return F.upper(reduce(lambda c, p: F.regexp_replace(c, F.lit(p[0]), F.lit(p[1])), TRIM, statement))


def is_ddl_or_dcl(normal: Column) -> Column:
    return normal.rlike("^(" + DDL_OR_DCL.replace(" ", "|") + ")")


def is_schema_change(normal: Column) -> Column:
    return normal.rlike("^(" + SCHEMA_CHANGES.replace(" ", "|") + ")")


def clears_database(normal: Column) -> Column:
    return normal.rlike("^(CREATE|DROP) (DATABASE|SCHEMA)")


def statement_kind(normal: Column) -> Column:
    return F.when(normal == "BEGIN", "begin").when(normal == "COMMIT", "commit").when(is_ddl_or_dcl(normal), "ddl").otherwise("query")


# Header and row patterns of dump text.
BINLOG_AT = r"CHANGE MASTER TO MASTER_LOG_FILE='([^']+)', MASTER_LOG_POS=(\d+);"
GTID_AT = (r"SET @@GLOBAL\.GTID_PURGED='([^']+)'", r"SET GLOBAL gtid_slave_pos='([^']+)'")
USE = r"^USE `([^`]+)`;"
INSERT = r"^INSERT INTO `([^`]+)` VALUES \((.*)\);$"


def dump_position(line: Column) -> tuple[Column, Column]:
    name, pos = F.regexp_extract(line, BINLOG_AT, 1), F.regexp_extract(line, BINLOG_AT, 2)
    return F.nullif(name, F.lit("")), F.when(pos != "", pos.cast("long"))


def dump_gtid(line: Column) -> Column:
    return F.coalesce(*(F.nullif(F.regexp_extract(line, p, 1), F.lit("")) for p in GTID_AT))


def dump_database(line: Column) -> Column:
    return F.nullif(F.regexp_extract(line, USE, 1), F.lit(""))


def dump_insert(line: Column) -> tuple[Column, Column]:
    return F.nullif(F.regexp_extract(line, INSERT, 1), F.lit("")), F.nullif(F.regexp_extract(line, INSERT, 2), F.lit(""))


def is_create(line: Column) -> Column:
    return line.rlike(r"^CREATE\s")


def trimmed_end(line: Column) -> Column:
    return F.regexp_replace(line, r"[\r\n]+$", "")


def split_values(values: str) -> list[str]:
    """The values of one row of dump text; quotes stay. Blanks after a comma are passed over. An open quote is an error."""
    out: list[str] = []
    at, n = 0, len(values)
    while at < n:
        while at < n and values[at] == " ":
            at += 1
        start = at
        if at < n and values[at] == "'":
            at += 1
            while at < n and values[at] != "'":
                at += 2 if values[at] == "\\" else 1
            if at >= n:
                raise ValueError(f"open quote in {values[start:start + 40]!r}")
            at += 1
        while at < n and values[at] != ",":
            at += 1
        out.append(values[start:at].rstrip(" "))
        if at == n - 1:
            out.append("")
        at += 1
    return out


# What a backslash and a letter stand for.
ESCAPES = {"n": "\n", "t": "\t", "0": "\0", "b": "\b", "Z": "\x1a", "r": "\r"}


def unescaped(text: str) -> str:
    """Backslash sequences read; any other letter stands for itself, and a lone backslash at the end goes."""
    it: Iterator[str] = iter(text)
    return "".join(c if c != "\\" else ESCAPES.get(d := next(it, ""), d) for c in it)


@F.pandas_udf(T.ArrayType(T.StringType()))
def values_of(values: pd.Series) -> pd.Series:
    return values.map(lambda v: None if v is None else split_values(v))


@F.pandas_udf(T.StringType())
def unescape(text: pd.Series) -> pd.Series:
    return text.map(lambda v: None if v is None else unescaped(v))


def wire_value(value: Column) -> Column:
    """Values travel as text with a flag: null is (true, "")."""
    return F.struct(value.isNull().alias("is_null"), F.coalesce(value.cast("string"), F.lit("")).alias("value"))


def unsigned(value: Column, bits: int) -> Column:
    """A signed integer read as an unsigned one of 8, 16, 32 or 64 bits."""
    if bits == 64:
        wide = value.cast("decimal(20,0)")
        return F.when(value < 0, wide + F.lit("18446744073709551616").cast("decimal(20,0)")).otherwise(wide).cast("decimal(20,0)")
    return value.cast("long").bitwiseAND(F.lit((1 << bits) - 1))


def context_value(ctx: Column, key: str, default, kind: str) -> Column:
    """A typed entry of a context map, or the default if it is missing; text that isn't a number is an error."""
    raw = ctx[key]
    return F.when(raw.isNull(), F.lit(default).cast(kind)).otherwise(raw.cast(kind))
