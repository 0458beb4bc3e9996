"""Sinks by name of their type, idempotent batches, and the engine that runs them."""

from __future__ import annotations

import json
import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark import __version__
from tidemark.functions import codec
from tidemark.operators import transport
from tidemark.operators.checkpoint import Manager
from tidemark.operators.filters import Sink, TableFilter, for_sink
from tidemark.operators.ops import as_json, counters, operation
from tidemark.operators.position import new_since, newest_progress
from tidemark.operators.schemas import Mirror
from tidemark.streaming import wire

_FACTORIES: dict[str, Callable[[dict], Handler]] = {}


class Handler:
    """What a sink does with its batch; the base does nothing."""

    def __init__(self, config: dict) -> None:
        self.config = config
        self.rule = TableFilter(tuple(config.get("include", ())), tuple(config.get("exclude", ())))

    def restore(self, context: dict) -> None:
        """What the last checkpoint kept for this sink, before the first batch."""

    def context(self) -> dict:
        """What the next checkpoint is to keep."""
        return {}

    def write(self, ops: DataFrame, batch: int) -> None:
        pass

    def close(self) -> None:
        pass


def register(kind: str, factory: Callable[[dict], Handler]) -> None:
    _FACTORIES[kind] = factory


def make(config: dict) -> Handler:
    if config.get("type") not in _FACTORIES:
        raise ValueError(f"unknown sink type {config.get('type')!r}")
    return _FACTORIES[config["type"]](config)


class StdoutSink(Handler):
    """One JSON text for each operation, in order; for looking at, not for resuming."""

    def write(self, ops: DataFrame, batch: int) -> None:
        for row in operation(ops).orderBy("seq").select(as_json(F.col("operation"), True).alias("j")).toLocalIterator():
            print(row.j, flush=True)


class TableSink(Handler):
    """Parquet files, a folder for each batch: a batch that is run again replaces its own."""

    def write(self, ops: DataFrame, batch: int) -> None:
        operation(ops).write.mode("overwrite").parquet(os.path.join(self.config["path"], f"batch={batch}"))


class KafkaSink(Handler):
    """Numbered binary messages, up to each flush point. Needs Spark's Kafka connector; one partition keeps their order.

    ``acked`` is the last number that the topic has taken; it goes into the sink's context, so that a restart numbers on from it.
    """

    def __init__(self, config: dict) -> None:
        super().__init__(config)
        self.acked = 0

    def restore(self, context: dict) -> None:
        self.acked = int(context.get("acked", 0))

    def context(self) -> dict:
        return {"acked": str(self.acked)}

    def messages(self, ops: DataFrame) -> DataFrame:
        kind = {"none": codec.NONE, "zlib": codec.ZLIB, "gzip": codec.GZIP}[self.config.get("compression", "none")]
        return wire.messages(ops, int(self.config.get("producer_id", 1)), self.acked + 1, int(self.config.get("max_payload", transport.MAX_PAYLOAD)), kind)

    def send(self, out: DataFrame) -> None:
        out.write.format("kafka").options(**{"kafka.bootstrap.servers": self.config["brokers"], "topic": self.config["topic"], "kafka.acks": "all", "kafka.max.in.flight.requests.per.connection": "1"}).save()

    def write(self, ops: DataFrame, batch: int) -> None:
        sent = self.messages(ops).persist()  # numbers are counted and sent alike
        last = sent.agg(F.max("seq")).first()[0]
        if last is not None:
            one = wire.on_the_wire(sent).repartition(1).sortWithinPartitions("seq")
            self.send(one.select("value", F.lit(int(self.config.get("partition", 0))).alias("partition")))
            self.acked = int(last)
        sent.unpersist()


for _kind, _factory in (("stdout", StdoutSink), ("table", TableSink), ("kafka", KafkaSink)):
    register(_kind, _factory)


class Hooks:
    """Called around schema and server changes; the base lets all pass."""

    def before_schema_change(self, batch: int, statements: list[str]) -> bool:
        return True

    def on_failed(self, statement: str, reason: str) -> None:
        pass

    def before_server_change(self, server_id: int) -> None:
        pass


class Parked(RuntimeError):
    """A schema change could not be applied: nothing behind it goes out until it is retried or passed over."""


class Engine:
    """Runs a changelog stream into sinks.

    A batch is cut at its schema and server changes. What comes before such a change goes to every sink and is checkpointed, then the
    change is made, then the rest goes on. A sink gets what is newer than its own progress; a part of a batch that comes again passes
    by the sinks that have written it. ``history`` keeps the mirror after each schema change.
    """

    def __init__(self, spark: SparkSession, sinks: list[dict], store, hooks: Hooks | None = None, history=None, retries: int = 2) -> None:
        self.spark, self.hooks, self.manager, self.history, self.retries = spark, hooks or Hooks(), Manager(store), history, retries
        self.mirror = (history.last() if history is not None else None) or Mirror()
        self.handlers = {c["name"]: make(c) for c in sinks}
        self.progress = {n: dict(self.manager.last(n)) for n in self.handlers}
        self.resumed = {n: dict(p) for n, p in self.progress.items()}
        for n, handler in self.handlers.items():
            handler.restore(self.progress[n].get("ctx", {}))
            self.manager.register(n, lambda n=n: self.progress[n])
        self.failed: dict | None = None
        self.passed: set[int] = set()  # schema changes that were applied or given up by hand
        self.server: int | None = None
        self.counts = {"trx_total": 0, "row_event_total": 0, "ddl_total": 0, "failed_ddl_total": 0, "operation_total": 0}
        self.mode = "init"

    def start_position(self) -> dict | None:
        """The least progress of the sinks, from which the log is to be read; None: from its start."""
        return self.manager.least()

    def _written(self, ops: DataFrame, number: int, part: int) -> None:
        """Brings every sink past these operations, and notes it."""
        end = newest_progress(ops).first()
        for name, handler in self.handlers.items():
            state = self.progress[name]
            had = state.get("ctx", {})
            if (int(had.get("batch", -1)), int(had.get("part", 0))) >= (number, part):
                continue
            at = self.resumed[name]
            own = new_since(ops, at["server_id"], at["log_name"], at["log_pos"]) if at.get("log_name") else ops
            handler.write(for_sink(own, Sink(name, handler.rule)), number * 1_000_000 + part)  # a number for each part of a batch
            if end is not None and (state.get("server_id"), state.get("log_name"), state.get("log_pos")) != tuple(end):
                state |= {"server_id": end["server_id"], "log_name": end["log_name"], "log_pos": end["log_pos"]}
            state["ctx"] = {**had, **handler.context(), "batch": number, "part": part}
            self.manager.save()

    def _applied(self, r) -> None:
        """Makes a schema change, or parks."""
        if r.seq in self.passed or not self.hooks.before_schema_change(r.seq, [r.statement]):
            return
        reason = ""
        for _ in range(1 + self.retries):
            try:
                self.mirror.apply(r.statement, r.database or "")
                break
            except Exception as e:
                reason = f"{type(e).__name__}: {e}"
        else:
            self.failed = {"seq": r.seq, "log_name": r.log_name, "log_pos": r.log_pos, "database": r.database, "statement": r.statement, "reason": reason}
            self.counts["failed_ddl_total"] += 1
            self.hooks.on_failed(r.statement, reason)
            raise Parked(reason)
        self._changed(r.seq, r.log_name, r.log_pos, r.database, r.statement)

    def _changed(self, seq: int, log_name: str, log_pos: int, database: str | None, statement: str) -> None:
        self.passed.add(seq)
        if self.history is not None:
            self.history.save(self.mirror, log_name, log_pos, database or "", statement)

    def batch(self, ops: DataFrame, number: int) -> None:
        """One micro-batch, up to the first schema change that fails."""
        self.mode = "standalone"
        if self.failed is not None:
            raise Parked(self.failed["reason"])
        servers = sorted((r.first_seq, r.server_id) for r in ops.groupBy("server_id").agg(F.min("seq").alias("first_seq")).collect())  # a row for each server
        changes = [(r.seq, r) for r in ops.where("op = 'ddl'").select("seq", "database", "statement", "log_name", "log_pos").orderBy("seq").toLocalIterator()]
        changes += [(first, server) for first, server in servers if self.server is not None and server != self.server or (first, server) != servers[0]]
        if self.server is None and servers:
            self.server = servers[0][1]
        low, part = None, 0
        for at, change in sorted(changes, key=lambda c: c[0]):
            before = ops.where(F.col("seq") < at) if low is None else ops.where((F.col("seq") >= low) & (F.col("seq") < at))
            self._written(before, number, part)
            low, part = at, part + 1
            if isinstance(change, int):
                self._on_server(change)
            else:
                self._applied(change)
        self._written(ops if low is None else ops.where(F.col("seq") >= low), number, part)
        n = counters(ops).drop("server_id").groupBy().sum().first()
        for name, x in zip(("trx_total", "row_event_total", "ddl_total", "operation_total"), n, strict=True):
            self.counts[name] += int(x or 0)

    def _on_server(self, server: int) -> None:
        """The sinks have all that the old server had: their position there is where all of them meet."""
        at = self.manager.least()
        if at is not None and self.manager.done(at["server_id"], at["log_name"], at["log_pos"]):
            self.manager.align(at["server_id"], at["log_name"], at["log_pos"])
        self.hooks.before_server_change(server)
        self.server = server

    def metrics(self) -> dict:
        return dict(self.counts)

    def close(self) -> None:
        for handler in self.handlers.values():
            handler.close()
        self.manager.save()

    def start(self, stream: DataFrame, checkpoint: str, interval: str | None = None):
        writer = stream.writeStream.foreachBatch(self.batch).option("checkpointLocation", checkpoint)
        return (writer.trigger(processingTime=interval) if interval else writer.trigger(availableNow=True)).start()

    def status(self) -> dict:
        return {"version": __version__, "mode": self.mode}

    def databases(self) -> list[str]:
        return sorted({d for d, _ in self.mirror.tables} | self.mirror.databases)

    def tables(self, database: str) -> list[str]:
        return sorted(t for d, t in self.mirror.tables if d == database.lower())

    def table_def(self, database: str, table: str):
        return self.mirror.table(database, table)

    def exec_ddl(self, statement: str) -> None:
        """On the mirror alone, without a current database; not kept."""
        self.mirror.apply(statement)

    def failed_ddl(self) -> dict | None:
        return self.failed

    def retry_ddl(self) -> None:
        """Makes the failed change on the mirror as it is now; the stream may go on after it."""
        if self.failed is None:
            raise ValueError("no schema change has failed")
        f = self.failed
        self.mirror.apply(f["statement"], f["database"] or "")
        self._changed(f["seq"], f["log_name"], f["log_pos"], f["database"], f["statement"])
        self.failed = None

    def pass_ddl(self) -> None:
        """Gives the failed change up."""
        if self.failed is None:
            raise ValueError("no schema change has failed")
        self.passed.add(self.failed["seq"])
        self.failed = None

    def synced(self) -> dict | None:
        return self.manager.least()


def snapshot(mirror: Mirror) -> str:
    """The mirror as text, for the history."""
    return json.dumps([[t.database, t.name, [[c.name, c.sql_type, c.key, c.charset, c.unsigned, c.nullable] for c in t.columns]] for _, t in sorted(mirror.tables.items())])
