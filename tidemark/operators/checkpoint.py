"""Checkpoints: least and aligned progress, barriers, lookup, storage documents."""

from __future__ import annotations

import json
import os
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _zero() -> Column:
    return (F.coalesce("log_name", F.lit("")) == "") & (F.coalesce("log_pos", F.lit(0)) == 0)


def registered(checkpoints: DataFrame, sinks: DataFrame) -> DataFrame:
    """Checkpoints of sinks that are configured."""
    return checkpoints.join(sinks, "sink", "left_semi")


def lookup(sinks: DataFrame, checkpoints: DataFrame) -> DataFrame:
    """(sink, server_id, log_name, log_pos) of each sink; a new one has zero progress."""
    got = sinks.select("sink").join(checkpoints, "sink", "left")
    return got.select("sink", F.coalesce("server_id", F.lit(0).cast("long")).alias("server_id"), F.coalesce("log_name", F.lit("")).alias("log_name"), F.coalesce("log_pos", F.lit(0).cast("long")).alias("log_pos"))


def least_progress(checkpoints: DataFrame, aligned: tuple[int, str, int] | None = None) -> DataFrame:
    """One row: the least non-zero progress. Sinks on several servers have none in common but the last aligned one; without it, an error."""
    known = checkpoints.where(~_zero())
    out = known.agg(F.count_distinct("server_id").alias("servers"), F.min(F.struct("log_name", "log_pos", "server_id")).alias("p"))
    stand_in = F.struct(F.lit(aligned[1]).alias("log_name"), F.lit(aligned[2]).cast("long").alias("log_pos"), F.lit(aligned[0]).cast("long").alias("server_id")) if aligned else F.raise_error(F.lit("sinks are on several servers and were never aligned")).cast("struct<log_name:string,log_pos:bigint,server_id:bigint>")
    return out.select(F.when(F.col("servers") <= 1, F.col("p")).otherwise(stand_in).alias("p")).select("p.server_id", "p.log_name", "p.log_pos")


def same_server(checkpoints: DataFrame) -> DataFrame:
    return checkpoints.where(~_zero()).agg((F.count_distinct("server_id") <= 1).alias("aligned"))


def reached(checkpoints: DataFrame, server_id: int, log_name: str, log_pos: int) -> DataFrame:
    """One row: whether every sink is on the server and at the position or later. A sink on another server isn't done."""
    there = (F.col("server_id") == server_id) & (F.struct("log_name", "log_pos") >= F.struct(F.lit(log_name), F.lit(log_pos).cast("long")))
    return checkpoints.agg(F.coalesce(F.bool_and(F.coalesce(there, F.lit(False))), F.lit(True)).alias("reached"))


def newest(documents: DataFrame) -> DataFrame:
    return documents.agg(F.max_by("data", "mtime").alias("data"))


def document(checkpoints: DataFrame) -> DataFrame:
    """The checkpoints as one JSON document, for storage; one row for each sink at most."""
    return checkpoints.agg(F.to_json(F.map_from_entries(F.array_sort(F.collect_list(F.struct("sink", F.struct("server_id", "log_name", "log_pos")))))).alias("data"))


PROGRESS_FIELDS = ("flavor string, server_id bigint, log_name string, log_pos bigint, gset string, ctx map<string,string>")


def full_document(checkpoints: DataFrame) -> DataFrame:
    """(data): all of each sink's progress, with its set, flavour and context, as one JSON document; one row for each sink at most."""
    fields = [f.split(" ")[0] for f in PROGRESS_FIELDS.split(", ")]
    return checkpoints.agg(F.to_json(F.map_from_entries(F.array_sort(F.collect_list(F.struct("sink", F.to_json(F.struct(*fields)).alias("p")))))).alias("data"))


def from_document(documents: DataFrame) -> DataFrame:
    """The checkpoints of JSON documents (data); text that isn't one is an error."""
    entries = F.from_json("data", "map<string,string>", {"mode": "FAILFAST"})
    each = documents.select(F.explode(entries).alias("sink", "p"))
    return each.select("sink", F.from_json("p", PROGRESS_FIELDS, {"mode": "FAILFAST"}).alias("p")).select("sink", "p.*")


class FileStore:
    """A checkpoint document in a file, replaced as a whole; damaged text is an error, no file is None."""

    def __init__(self, path: str) -> None:
        self.path = path

    def save(self, state: dict) -> None:
        os.makedirs(os.path.dirname(self.path) or ".", exist_ok=True)
        with open(f"{self.path}.new", "w", encoding="utf-8") as f:
            json.dump(state, f)
            f.flush()
            os.fsync(f.fileno())
        os.replace(f"{self.path}.new", self.path)

    def load(self) -> dict | None:
        if not os.path.exists(self.path):
            return None
        with open(self.path, encoding="utf-8") as f:
            return json.load(f)


class MemoryStore:
    def __init__(self) -> None:
        self.state: dict | None = None

    def save(self, state: dict) -> None:
        self.state = json.loads(json.dumps(state))

    def load(self) -> dict | None:
        return self.state


class Manager:
    """Progress of each sink. Names are unique; ``save`` keeps what each sink reports; hooks run when a barrier is passed."""

    def __init__(self, store) -> None:
        self.store = store
        state = store.load() or {"aligned": None, "sinks": {}}
        self.aligned, self.saved = state["aligned"], state["sinks"]
        self.sinks: dict[str, Callable[[], dict]] = {}

    def register(self, name: str, report: Callable[[], dict]) -> None:
        if name in self.sinks:
            raise ValueError(f"sink {name} is registered already")
        self.sinks[name] = report

    def last(self, name: str) -> dict:
        return self.saved.get(name, {"server_id": 0, "log_name": "", "log_pos": 0, "ctx": {}})

    def save(self) -> None:
        self.saved = {n: r() for n, r in self.sinks.items()}
        self.store.save({"aligned": self.aligned, "sinks": self.saved})

    def done(self, server_id: int, log_name: str, log_pos: int) -> bool:
        now = [r() for r in self.sinks.values()]
        return all(p["server_id"] == server_id and (p["log_name"], p["log_pos"]) >= (log_name, log_pos) for p in now)

    def align(self, server_id: int, log_name: str, log_pos: int) -> None:
        """After a barrier, before the server changes."""
        if not self.done(server_id, log_name, log_pos):
            raise RuntimeError("sinks have not come that far")
        self.aligned = {"server_id": server_id, "log_name": log_name, "log_pos": log_pos}
        self.save()

    def least(self) -> dict | None:
        known = [p for p in self.saved.values() if p["log_name"] or p["log_pos"]]
        if len({p["server_id"] for p in known}) > 1:
            if self.aligned is None:
                raise RuntimeError("sinks are on several servers and were never aligned")
            return self.aligned
        return min(known, key=lambda p: (p["log_name"], p["log_pos"]), default=None)
