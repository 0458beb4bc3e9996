"""Stateful operators of the stream: duplicates by sequence, reassembly of fragments."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


class SequenceDedup(StatefulProcessor):
    """Takes number n + 1 after n; repeats are dropped, and what lies beyond a gap waits for it, or for ever in its absence."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.current = handle.getValueState("current", "seq long")
        self.waiting = handle.getMapState("waiting", "seq long", "payload string")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        got = pd.concat(list(rows)).sort_values("seq")
        last = self.current.get()[0] if self.current.exists() else None
        out = []

        def take(seq: int, payload: str) -> None:
            nonlocal last
            out.append((key[0], seq, payload))
            last = seq

        for seq, payload in zip(got["seq"].tolist(), got["payload"].tolist(), strict=True):
            if last is None or seq == last + 1:
                take(seq, payload)
                while self.waiting.containsKey((last + 1,)):
                    nxt = last + 1
                    value = self.waiting.getValue((nxt,))[0]
                    self.waiting.removeKey((nxt,))
                    take(nxt, value)
            elif seq > last and not self.waiting.containsKey((seq,)):
                self.waiting.updateValue((seq,), (payload,))
        if last is not None:
            self.current.update((last,))
        if out:
            yield pd.DataFrame(out, columns=["producer_id", "seq", "payload"])

    def close(self) -> None:
        pass


def dedup_stream(messages: DataFrame) -> DataFrame:
    """(producer_id, seq, payload) once each and in sequence; the session's state store must be RocksDB's."""
    return messages.groupBy("producer_id").transformWithStateInPandas(SequenceDedup(), "producer_id long, seq long, payload string", "Append", "None")


class Reassembly(StatefulProcessor):
    """Holds the fragments of the producer's open group; a fragment of another group drops an unfinished one."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.group = handle.getValueState("group", "group_id long")
        self.parts = handle.getListState("parts", "payload string")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        out = []
        for r in pd.concat(list(rows)).sort_values("seq").itertuples():
            if not self.group.exists() or self.group.get()[0] != r.group_id:
                self.parts.clear()
                self.group.update((int(r.group_id),))
            self.parts.appendValue((r.payload,))
            if not r.more_fragment:
                out.append((key[0], int(r.group_id), "".join(p[0] for p in self.parts.get())))
                self.parts.clear()
                self.group.clear()
        if out:
            yield pd.DataFrame(out, columns=["producer_id", "group_id", "payload"])

    def close(self) -> None:
        pass


def reassemble_stream(messages: DataFrame) -> DataFrame:
    return messages.groupBy("producer_id").transformWithStateInPandas(Reassembly(), "producer_id long, group_id long, payload string", "Append", "None")
