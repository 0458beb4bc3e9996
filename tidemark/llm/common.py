"""What the operators of this subpackage share: reading tables, shared folders, Arrow maps, hashes and small models."""

from __future__ import annotations

import atexit
import contextlib
import ctypes
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: A word: characters that are no ASCII white space. ``bytes.split()`` finds the same words in UTF-8.
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """A new folder below spark.checkpoint.dir, which the driver and all executors see; set only where it is unset (tests)."""
    top = spark.conf.get("spark.checkpoint.dir", None)
    if not top:
        top = spark.conf.get("spark.sql.warehouse.dir") + "/checkpoints"
        if spark.sparkContext.getConf().get("spark.master", "").startswith("local[") is False:
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    top = f"{top.rstrip('/')}/tidemark-{spark.sparkContext.applicationId}"
    if top not in _FOLDERS:
        _FOLDERS.add(top)
        atexit.register(_delete, spark, top)
    return f"{top}/{uuid.uuid4().hex}"


#: Folders of this process's applications: gone when it ends.
_FOLDERS: set[str] = set()


def _delete(spark: SparkSession, path: str) -> None:
    with contextlib.suppress(Exception):  # the session may have ended
        at = spark._jvm.org.apache.hadoop.fs.Path(path)
        at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


def stored(df: DataFrame) -> DataFrame:
    """df written to the shared folder and read again: a cut of the lineage that survives lost executors."""
    spark = df.sparkSession
    path = shared_folder(spark)
    df.write.option("compression", "zstd").parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._tm_path = path
    return out


def forget(*tables: DataFrame) -> None:
    """Deletes what ``stored`` wrote, once nothing reads it any more."""
    for t in tables:
        _delete(t.sparkSession, t._tm_path)


def fold(doc_id: str, n: int) -> Column:
    """crc32(doc_id as text) mod n; a null id counts as empty text."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")) % n


def utf8(text: str) -> Column:
    """The text's UTF-8 bytes; null is empty."""
    return F.coalesce(F.col(text).cast("binary"), F.lit(b""))


#: Bytes of an Arrow batch that goes to a worker, about: long texts come in batches of few rows.
BATCH_BYTES = 8 << 20


def bounded_batches(df: DataFrame) -> DataFrame:
    """df, whose session sends batches of bounded size to Python from now on."""
    df.sparkSession.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    return df


#: What this worker keeps from task to task, by operator: how it is let go. A worker serves many operators in turn.
_KEPT: dict[str, Callable[[], None]] = {}


def keep(owner: str, drop: Callable[[], None]) -> None:
    _KEPT[owner] = drop


def let_go(owner: str = "") -> None:
    """Drops what operators other than ``owner`` keep in this worker."""
    for name in [n for n in _KEPT if n != owner]:
        _KEPT.pop(name)()


def map_rows(df: DataFrame, rows: Callable[..., Iterator[tuple]], schema: str, chunk: int = 2000, owner: str = "") -> DataFrame:
    """mapInArrow with a generator: rows(iterator of input tuples) yields output tuples, sent in chunks of bounded length."""
    from pyspark.sql.types import StructType
    from pyspark.sql.pandas.types import to_arrow_schema

    struct = StructType.fromDDL(schema)
    arrow = to_arrow_schema(struct)

    def tuples(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        for b in batches:
            for at in range(0, b.num_rows, 256):
                yield from zip(*(c.to_pylist() for c in b.slice(at, 256).columns), strict=True)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        let_go(owner)
        held: list[tuple] = []
        for row in rows(tuples(batches)):
            held.append(row)
            if len(held) >= chunk:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), arrow, strict=True)], schema=arrow)
                held = []
        if held:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), arrow, strict=True)], schema=arrow)
        hand_back()

    return bounded_batches(df).mapInArrow(run, struct)


def summed(parts: DataFrame) -> dict[int, np.ndarray]:
    """By k, the sum of vectors of doubles from rows (k int, n long, blob binary): added up one by one in order of n, so that neither a task nor the driver holds more than one of each k."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, total = None, None
        for b in batches:
            for k, blob in zip(b.column(0).to_pylist(), b.column(2), strict=True):
                x = np.frombuffer(blob.as_buffer(), np.float64)
                if k == now:
                    total += x
                    continue
                if now is not None:
                    yield pa.RecordBatch.from_arrays([pa.array([now], pa.int32()), pa.array([total.tobytes()])], names=["k", "blob"])
                now, total = k, x.copy()
        if now is not None:
            yield pa.RecordBatch.from_arrays([pa.array([now], pa.int32()), pa.array([total.tobytes()])], names=["k", "blob"])
        hand_back()

    got = bounded_batches(parts).repartition("k").sortWithinPartitions("k", "n").mapInArrow(run, "k int, blob binary").toArrow()
    return {k: np.frombuffer(b, np.float64) for k, b in zip(got.column("k").to_pylist(), got.column("blob").to_pylist(), strict=True)}


def hand_back() -> None:
    """Freed memory of this worker goes back to the system: it stays alive between tasks, and would keep the largest task's."""
    pa.default_memory_pool().release_unused()
    libc = ctypes.CDLL(None)
    if hasattr(libc, "malloc_trim"):
        libc.malloc_trim(0)


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


def fit_logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray | None = None, ridge: float = 1e-3, steps: int = 25, rows: int | None = None) -> np.ndarray:
    """Ridge logistic regression by Newton steps; x needs its own column of ones. Slices of ``rows`` rows of x (None: all) are taken as doubles at once."""
    w = np.zeros(x.shape[1])
    weight = np.ones(len(y)) if weight is None else weight
    for _ in range(steps):
        g, h = ridge * len(y) * w, (ridge * len(y) + 1e-6) * np.eye(x.shape[1])
        for at in range(0, len(y), rows or max(1, len(y))):
            s = slice(at, at + rows if rows else None)
            part = np.asarray(x[s], float)
            p = sigmoid(part @ w)
            g = part.T @ (weight[s] * (p - y[s])) + g
            h = (part * (weight[s] * p * (1 - p))[:, None]).T @ part + h
        step = np.linalg.solve(h, g)
        w -= step
        if np.abs(step).max() < 1e-7:
            break
    return w
