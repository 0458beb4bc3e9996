"""Suffix-array deduplication: removal of every byte in a 100-byte string that also starts earlier.

Sharding comes first, the suffix sort after. Of the GRAM-byte strings in a 100-byte string the one with the smallest hash is its
anchor, so that equal 100-byte strings have equal anchors at equal places. Anchors that come up once in the corpus are let go. Each
other one is cut out with all 100-byte strings that it stands for (its context), and the contexts of an anchor go to one shard.
There, equal contexts become one, and external induced sorting (``suffixes``) finds, by common prefixes of 100 bytes and more, all
strings that other contexts repeat. Nothing is compared but bytes: hashes only decide what meets.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import bounded_batches, forget, hand_back, let_go, map_rows, stored, table, utf8
from tidemark.llm.hashing import mix
from tidemark.llm.suffixes import suffixes

LENGTH, GRAM = 100, 32
WINDOW = LENGTH - GRAM + 1  # grams in a string
#: Bytes of text that anchors are looked for at once, and distinct bytes that a suffix sort takes together (one anchor's contexts may be more).
CHUNK, SORTED = 1 << 19, 1 << 21
_U = np.uint64
_P = 0x9E3779B97F4A7C15
_BYTE = mix(np.arange(1, 257, dtype=_U))


def _powers(n: int, base: int) -> np.ndarray:
    return np.multiply.accumulate(np.full(n, base & 0xFFFFFFFFFFFFFFFF, _U))


_TABLES: list[np.ndarray] = []


def _tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    if not _TABLES or len(_TABLES[0]) < n:
        n = max(n, 1 << 16)
        _TABLES[:] = [_powers(n, _P), _powers(n, pow(_P, -1, 1 << 64))]
    return _TABLES[0], _TABLES[1]


def _sliding(x: np.ndarray, k: int, f) -> np.ndarray:
    """f over each run of k values, by doubling."""
    width = 1
    while 2 * width <= k:
        x = f(x[: len(x) - width], x[width:])
        width *= 2
    return f(x[: len(x) - (k - width)], x[k - width :]) if width < k else x


def anchors(data: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(places, hashes, most, least) of the anchors in texts laid end to end; ends are the texts' ends.

    The strings that an anchor stands for start between ``most`` and ``least`` bytes before it.
    """
    n = len(data)
    if n < LENGTH:
        return np.zeros(0, np.int64), np.zeros(0, _U), np.zeros(0, np.int64), np.zeros(0, np.int64)
    up, down = _tables(n)
    total = np.zeros(n + 1, _U)
    np.cumsum(_BYTE[data] * up[:n], out=total[1:])
    gram = (total[GRAM:] - total[:-GRAM]) * down[: n - GRAM + 1]
    gram ^= gram >> _U(31)
    gram *= _U(0xBF58476D1CE4E5B9)
    least = _sliding(gram, WINDOW, np.minimum)  # for each start of a string
    starts = np.concatenate([[0], ends[:-1]])
    for a, b in zip(np.maximum(starts, ends - LENGTH + 1), ends, strict=True):
        least[a:b] = 0  # strings across a text's end
    padded = np.zeros(len(gram) + WINDOW - 1, _U)
    padded[WINDOW - 1 : WINDOW - 1 + len(least)] = least
    top = _sliding(padded, WINDOW, np.maximum)
    at = np.flatnonzero((top == gram) & (gram > 0))
    own = gram[at]
    most, nearest = np.zeros(len(at), np.int64), np.full(len(at), WINDOW)
    fenced = np.concatenate([np.zeros(WINDOW, _U), least, np.zeros(WINDOW, _U)])
    for k in range(WINDOW):
        mine = fenced[at + (WINDOW - k)] == own
        most[mine] = k
        nearest[mine & (nearest == WINDOW)] = k
    return at, own, most, nearest


def coded(place: np.ndarray, most: np.ndarray, nearest: np.ndarray) -> np.ndarray:
    """A place with the extent of its strings, as one number in order of place."""
    return (place * WINDOW + most) * WINDOW + nearest


def extent(code: int) -> tuple[int, int, int]:
    """(first byte, end, the anchor's offset) of the context that a number of ``coded`` stands for."""
    rest, nearest = divmod(code, WINDOW)
    place, most = divmod(rest, WINDOW)
    return place - most, place - nearest + LENGTH, most


def pieces(raw: bytes) -> Iterator[tuple[int, bytes]]:
    """(offset, bytes) of parts of a text, which share LENGTH - 1 bytes with the next, so that each 100-byte string is in one."""
    for at in range(0, max(1, len(raw) - LENGTH + 1), CHUNK):
        yield at, raw[at : at + CHUNK + LENGTH - 1]


def _batches(docs: Iterator[tuple]) -> Iterator[list[tuple[tuple, int, bytes]]]:
    """Parts of texts in lists of about CHUNK bytes: (key, offset, bytes)."""
    held, size = [], 0
    for *key, raw in docs:
        if len(raw) < LENGTH:
            continue
        for at, part in pieces(raw):
            held.append((tuple(key), at, part))
            size += len(part)
            if size >= CHUNK:
                yield held
                held, size = [], 0
    if held:
        yield held


def _with_end(batches: Iterator) -> Iterator:
    yield from batches
    yield None


def repeated_anchors(rows: DataFrame) -> DataFrame:
    """(row, places) with the anchors (``coded``), of rows (row, raw), that the corpus has twice or more.

    A task sends one row for each anchor and batch, and says whether the batch had more; those go along under keys of their own, so
    that a passage in very many texts makes no large group.
    """

    def find(docs: Iterator[tuple]) -> Iterator[tuple]:
        for batch in _batches(docs):
            data = np.frombuffer(b"".join(b[2] for b in batch), np.uint8)
            ends = np.cumsum([len(b[2]) for b in batch])
            at, gram, most, nearest = anchors(data, ends)
            text = np.searchsorted(ends, at, "right")
            starts = np.concatenate([[0], ends[:-1]])
            owner = np.array([b[0][0] for b in batch], np.int64)[text]
            place = coded(at - starts[text] + np.array([b[1] for b in batch])[text], most, nearest)
            order = np.lexsort((place, owner, gram))
            g, o, p = gram[order].view(np.int64), owner[order], place[order]
            keep = np.ones(len(g), bool)
            keep[1:] = (g[1:] != g[:-1]) | (o[1:] != o[:-1]) | (p[1:] != p[:-1])  # parts of a text overlap, and rows may repeat
            g, o, p = g[keep], o[keep], p[keep]
            first = np.ones(len(g), bool)
            first[1:] = g[1:] != g[:-1]
            more = np.zeros(len(g), bool)
            more[:-1] = ~first[1:]
            known = more | ~first
            key = np.where(first, g, mix((o ^ p).view(_U)).view(np.int64))
            packed = np.where(first, 2 * p + known, -1 - p)  # the others are known all
            for a in range(0, len(g), 100_000):
                s = slice(a, a + 100_000)
                yield pa.RecordBatch.from_arrays([pa.array(key[s]), pa.array(o[s]), pa.array(packed[s])], names=["key", "row", "packed"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        let_go()
        yield from find(t for b in batches for at in range(0, b.num_rows, 256) for t in zip(*(c.to_pylist() for c in b.slice(at, 256).columns), strict=True))
        hand_back()

    def again(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows in order of key: keeps those whose anchor has a second place, or is known to have one elsewhere."""
        key, row, packed = (np.zeros(0, np.int64) for _ in range(3))
        last = False
        for b in _with_end(batches):
            # the last row waits, for whether the next has its key
            new = (np.zeros(0, np.int64),) * 3 if b is None else tuple(b.column(k).to_numpy(zero_copy_only=False) for k in range(3))
            key, row, packed = (np.concatenate(x) for x in zip((key, row, packed), new, strict=True))
            if not len(key):
                continue
            own = packed >= 0
            same = (key[1:] == key[:-1]) & own[1:] & own[:-1]
            keep = ~own | (packed & 1 == 1)
            keep[0] |= last
            keep[1:] |= same
            keep[:-1] |= same
            last = bool(same[-1]) if len(same) else last
            end = len(key) if b is None else len(key) - 1
            at = np.flatnonzero(keep[:end])
            if len(at):
                yield pa.RecordBatch.from_arrays([pa.array(row[at]), pa.array(np.where(own[at], packed[at] >> 1, -1 - packed[at]))], names=["row", "place"])
            key, row, packed = key[end:], row[end:], packed[end:]

    found = bounded_batches(rows).select("row", "raw").mapInArrow(run, "key long, row long, packed long")
    met = found.repartition("key").sortWithinPartitions("key", "packed").mapInArrow(again, "row long, place long")
    return met.groupBy("row").agg(F.collect_set("place").alias("places"))


def _merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[list[int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return [(a, b) for a, b in out]


def contexts(texts: DataFrame) -> DataFrame:
    """Contexts of the anchors of rows (id, row, raw, places): (key, gram, id, row, lo, context), or for key shared in a batch (.., lo, hi).

    Of equal contexts in a batch the earliest goes on; the others are repeats throughout, and only their extents go on, under keys of
    their own.
    """

    def rows(docs: Iterator[tuple]) -> Iterator[tuple]:
        best: dict[tuple[int, bytes], tuple] = {}
        size = 0
        spans: dict[tuple, list] = {}

        def flush() -> Iterator[tuple]:
            for (off, context), (doc, row, lo) in best.items():
                yield int.from_bytes(hashlib.blake2b(context[off : off + GRAM], digest_size=8).digest(), "big", signed=True), True, doc, row, lo, lo + len(context), off, context
            for (doc, row), found in spans.items():
                for lo, hi in _merged(found):
                    yield (row ^ lo * 0x9E3779B9) & 0x7FFFFFFFFFFFFFFF, False, doc, row, lo, hi, 0, b""
            best.clear()
            spans.clear()

        for doc, row, raw, places in docs:
            for code in sorted(places):
                lo, hi, off = extent(code)
                key = off, raw[lo:hi]
                at = doc, row, lo
                had = best.setdefault(key, at)
                if had is not at and had != at:
                    best[key], other = min(had, at), max(had, at)
                    spans.setdefault(other[:2], []).append((other[2], other[2] + hi - lo))
                size += 1
            if size > 50_000:
                yield from flush()
                size = 0
        yield from flush()

    return map_rows(texts, rows, "key long, context_row boolean, id long, row long, lo long, hi long, off int, context binary", chunk=5000)


def repeats_in(found: list[tuple[bytes, tuple[int, int, int]]]) -> Iterator[tuple[tuple[int, int, int], list[int]]]:
    """For distinct contexts with their earliest place (id, row, lo): the offsets of 100-byte strings that also start earlier, elsewhere among them."""
    lengths = np.array([len(c) for c, _ in found])
    starts = np.concatenate([[0], np.cumsum(lengths + 1)])
    text = np.empty(starts[-1] + 1, np.uint16)
    flat = np.frombuffer(b"\x00".join(c for c, _ in found) + b"\x00", np.uint8)
    text[:-1] = flat
    text[:-1] += 2
    text[starts[1:] - 1] = 1
    text[-1] = 0
    owner = np.repeat(np.arange(len(found)), lengths + 1)
    place = np.array([p for _, p in found], np.int64).reshape(-1, 3)
    out: dict[int, list[int]] = {}

    def group(at: np.ndarray, ends: np.ndarray) -> None:
        """at: places in suffix order; ends: where each group of equal strings ends."""
        who = owner[at]
        offset = at - starts[who]
        fits = offset + LENGTH <= lengths[who]
        number = np.repeat(np.arange(len(ends)), np.diff(np.concatenate([[0], ends])))
        who, offset, number = who[fits], offset[fits], number[fits]
        begin = place[who, 2] + offset
        order = np.lexsort((begin, place[who, 1], place[who, 0], number))
        n, w, o, b = number[order], who[order], offset[order], begin[order]
        d, r = place[w, 0], place[w, 1]
        new = np.concatenate([[True], n[1:] != n[:-1]])
        lead = np.maximum.accumulate(np.where(new, np.arange(len(n)), 0))
        later = (d != d[lead]) | (r != r[lead]) | (b != b[lead])
        for i, x in zip(w[later].tolist(), o[later].tolist(), strict=True):
            out.setdefault(i, []).append(x)

    tail = np.zeros(0, np.int64)
    for at, common in suffixes(text, LENGTH):
        joined = np.concatenate([tail, at])
        like = np.concatenate([np.ones(len(tail), bool), common >= LENGTH])
        if len(like):
            like[0] = False
        heads = np.flatnonzero(~like)
        cut = heads[-1] if len(heads) else 0
        if cut:
            body, ends = joined[:cut], np.append(heads[1:], len(joined))[: len(heads) - 1] if heads[-1] == cut else heads
            sizes = np.diff(np.concatenate([heads[:-1], [cut]]))
            keep = np.repeat(sizes > 1, sizes)
            if keep.any():
                group(body[keep], np.cumsum(sizes[sizes > 1]))
        tail = joined[cut:]
    if len(tail) > 1:
        group(tail, np.array([len(tail)]))
    for i, offsets in out.items():
        yield found[i][1], offsets


def repeat_spans(cut: DataFrame) -> DataFrame:
    """(id, row, lo, hi) of what is to go, in pieces that may overlap, from ``contexts``."""

    def rows(found: Iterator[tuple]) -> Iterator[tuple]:
        block: list[tuple[bytes, tuple[int, int, int]]] = []  # distinct contexts of whole keys
        own: list[tuple[bytes, tuple[int, int, int]]] = []  # of the key at hand
        size, last, at = 0, None, None

        def done() -> Iterator[tuple]:
            spans: dict[tuple[int, int], list] = {}
            for (doc, row, lo), offsets in repeats_in(block):
                spans.setdefault((doc, row), []).extend((lo + o, lo + o + LENGTH) for o in offsets)
            block.clear()
            for (doc, row), all_ in spans.items():
                for lo, hi in _merged(all_):
                    yield doc, row, lo, hi

        for key, whole, doc, row, lo, hi, off, context in found:
            if not whole:
                yield doc, row, lo, hi
                continue
            if key != last:
                if len(own) > 1:  # a lone context has nothing to match
                    block += own
                    size += sum(len(c) for c, _ in own)
                own, last, at = [], key, None
                if size >= SORTED:
                    yield from done()
                    size = 0
            if at is not None and (off, context) == at[0]:
                if (doc, row, lo) != at[1]:  # equal contexts come in order of place
                    yield doc, row, lo, hi
            else:
                at = (off, context), (doc, row, lo)
                own.append((context, at[1]))
        if len(own) > 1:
            block += own
        if block:
            yield from done()

    ordered = cut.repartition("key").sortWithinPartitions("key", "context_row", "off", "context", "id", "row", "lo")
    return map_rows(ordered, rows, "id long, row long, lo long, hi long", chunk=20_000)


def keyed(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """docs with _tm_raw and _tm_row, a key of the row: rows that repeat id and text have one, and are dealt with as one."""
    return docs.withColumn("_tm_raw", utf8(text)).withColumn("_tm_row", F.xxhash64(F.col(doc_id), F.col("_tm_raw")))


def removals(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> tuple[DataFrame, DataFrame]:
    """(row, spans) of the rows that lose bytes, spans as merged arrays [lo, hi); and (row, raw) of at least these rows."""
    rows = keyed(docs, doc_id, text).select(F.coalesce(F.col(doc_id).cast("long"), F.lit(-(2**63))).alias("id"), F.col("_tm_row").alias("row"), F.col("_tm_raw").alias("raw"))
    found = stored(repeated_anchors(rows))
    texts = stored(rows.join(found, "row").dropDuplicates(["row"]))
    forget(found)
    spans = repeat_spans(contexts(texts.select("id", "row", "raw", "places")))

    def merge(rows: Iterator[tuple]) -> Iterator[tuple]:
        for row, los, his in rows:
            yield row, [list(x) for x in _merged(list(zip(los, his, strict=True)))]

    grouped = spans.groupBy("row").agg(F.collect_list(F.struct("lo", "hi")).alias("s")).select("row", F.col("s.lo"), F.col("s.hi"))
    return map_rows(grouped, merge, "row long, spans array<array<bigint>>"), texts.select("row", "raw")


def cut_texts(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(row, spans, rest) of the rows that lose bytes: rest is what is left, as bytes."""
    spans, texts = removals(docs, doc_id, text)

    def rows(found: Iterator[tuple]) -> Iterator[tuple]:
        for row, spans, raw in found:
            at, kept = 0, []
            for lo, hi in spans:
                kept.append(raw[at:lo])
                at = hi
            yield row, spans, b"".join([*kept, raw[at:]])

    return map_rows(spans.join(texts, "row").select("row", "spans", "raw"), rows, "row long, spans array<array<bigint>>, rest binary", chunk=500)


def deduplicated(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """docs with repeats cut out of the texts; n_chars, if docs has it, is counted anew where a text changed.

    Null texts stay null, other columns stay as they are, and no row goes, even if nothing is left of its text. A character that a
    removal cuts through goes as a whole. Rows that repeat id and text are one document: neither is a copy of the other. Rows that
    share an id and differ in text are ordered by a hash of both. Null ids come before all others.
    """
    cut = cut_texts(docs, doc_id, text)

    def rows(found: Iterator[tuple]) -> Iterator[tuple]:
        for row, raw in found:
            yield row, raw.decode("utf-8", "ignore")

    new = map_rows(cut.select("row", "rest"), rows, "_tm_new_row long, _tm_rest string", chunk=500)
    joined = keyed(docs, doc_id, text).join(new, F.col("_tm_row") == F.col("_tm_new_row"), "left")
    out = joined.withColumn(text, F.coalesce("_tm_rest", F.col(text)))
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.when(F.col("_tm_rest").isNotNull(), F.length("_tm_rest").cast(docs.schema["n_chars"].dataType)).otherwise(F.col("n_chars")))
    return out.select(*docs.columns)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    gone = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s[1] - s[0])
    cut = stored(cut_texts(docs).select(F.col("row").alias("_tm_cut"), gone.alias("n_removed"), F.size("spans").cast("long").alias("n_spans"), F.sha2("rest", 256).alias("cut_sha256")))
    whole = keyed(docs, "doc_id", "text").select("doc_id", "_tm_row", F.length("_tm_raw").cast("long").alias("n_bytes"), F.sha2("_tm_raw", 256).alias("whole_sha256"))
    out = whole.join(cut, F.col("_tm_row") == F.col("_tm_cut"), "left")
    return out.select("doc_id", "n_bytes", F.coalesce("n_removed", F.lit(0).cast("long")).alias("n_removed"), F.coalesce("n_spans", F.lit(0).cast("long")).alias("n_spans"), F.coalesce("cut_sha256", "whole_sha256").alias("kept_sha256"))
