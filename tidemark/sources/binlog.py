"""A changelog in Parquet as a data source named ``binlog``, for batch and streaming reads."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition, SimpleDataSourceStreamReader

from tidemark.operators.gtid import flavour, parsed

SCHEMA = "seq bigint, server_id bigint, log_name string, log_pos bigint, op string, timestamp bigint, gtid string, database string, table string, statement string"
COLUMNS = [c.strip().split(" ")[0] for c in SCHEMA.split(",")]


@dataclass
class FilePart(InputPartition):
    path: str
    after: tuple[int, str, int]
    gset: str = ""


def options_of(options: dict) -> dict:
    """Validated options: a path; start by file and offset, or by GTID set, which must not be empty then; rows in full images only."""
    if not options.get("path"):
        raise ValueError("binlog: option path is required")
    if options.get("binlogformat", "ROW").upper() != "ROW":
        raise ValueError("binlog: only row format can be read")
    if options.get("rowimage", "FULL").upper() not in ("FULL", "MINIMAL", "NOBLOB"):
        raise ValueError("binlog: row image must be FULL, MINIMAL or NOBLOB")
    if options.get("gtidenabled", "false").lower() == "true" and not options.get("gset"):
        raise ValueError("binlog: a GTID start needs option gset")
    return options


def files(path: str) -> list[str]:
    import pyarrow.dataset as ds

    return sorted(ds.dataset(path, format="parquet").files)


def behind(found, after: tuple[int, str, int], gset: str = ""):
    """Rows behind a position of their server (rows of another server are all behind it), of transactions that the set doesn't have."""
    server, name, pos = after
    known, by_uuid = parsed(gset), flavour(gset) == "mysql"

    def had(gtid: str | None) -> bool:
        if by_uuid:
            source, _, number = (gtid or "").partition(":")
        else:
            source, _, number = (*(gtid or "").split("-"), "", "", "")[:3]
        return number.isdigit() and any(lo <= int(number) <= hi for lo, hi in known.get(source.lower(), ()))

    for r in found:
        if (r[1] != server or (r[2], r[3]) > (name, pos)) and not (known and had(r[6])):
            yield r


def rows(path: str, after: tuple[int, str, int], gset: str = ""):
    import pyarrow.dataset as ds

    for b in ds.dataset(path, format="parquet").to_batches(columns=COLUMNS):
        yield from behind(zip(*(c.to_pylist() for c in b.columns), strict=True), after, gset)


class BinlogSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "binlog"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> BinlogReader:
        return BinlogReader(options_of(dict(self.options)))

    def simpleStreamReader(self, schema) -> BinlogStream:
        return BinlogStream(options_of(dict(self.options)))


def _start(options: dict) -> tuple[int, str, int]:
    return int(options.get("serverid", 0)), options.get("logname", ""), int(options.get("logpos", 0))


class BinlogReader(DataSourceReader):
    """A partition for each file."""

    def __init__(self, options: dict) -> None:
        self.options = options

    def partitions(self) -> list[FilePart]:
        return [FilePart(f, _start(self.options), self.options.get("gset", "")) for f in files(self.options["path"])]

    def read(self, partition: FilePart):
        return rows(partition.path, partition.after, partition.gset)


class BinlogStream(SimpleDataSourceStreamReader):
    """For control streams: each batch is read on the driver, in order of ``seq``, ``batchsize`` rows at most and whole positions.

    The offset is the last sequence number that was read. A batch's end comes from the sequence numbers alone; only its own rows are
    read, from the row groups that can have them.
    """

    def __init__(self, options: dict) -> None:
        self.options, self.most = options, int(options.get("batchsize", 10_000))

    def initialOffset(self) -> dict:
        return {"seq": -1}

    def _numbers(self, after: int) -> list[int]:
        import pyarrow.dataset as ds

        found = ds.dataset(files(self.options["path"]), format="parquet").to_table(columns=["seq"], filter=ds.field("seq") > after)
        return sorted(found.column("seq").to_pylist())[: self.most]

    def _between(self, start: int, end: int):
        import pyarrow.dataset as ds

        t = ds.dataset(files(self.options["path"]), format="parquet").to_table(columns=COLUMNS, filter=(ds.field("seq") > start) & (ds.field("seq") <= end)).sort_by("seq")
        return iter(list(behind(zip(*(c.to_pylist() for c in t.columns), strict=True), _start(self.options), self.options.get("gset", ""))))

    def read(self, start: dict):
        numbers = self._numbers(start["seq"])
        end = {"seq": numbers[-1]} if numbers else start
        return self._between(start["seq"], end["seq"]), end

    def readBetweenOffsets(self, start: dict, end: dict):
        return self._between(start["seq"], end["seq"])
