"""Approximate nearest neighbours by multi-index hashing of learned rotated binary codes."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidemark.llm.common import stored, table

#: Different vectors that the rotation and the radius are learned from, at most: those with the smallest hash.
SAMPLE = 8_000
#: Bits of a code at most, and of a substring.
BITS, SUBSTRING = 64, 16
#: Different vectors and queries that meet in one task.
BASE, QUERIES = 20_000, 2_000
NEAREST = 10
#: Groups that a very common vector's rows are dealt to.
SALTS = 8
#: Share of true neighbours in the sample that the radius must reach.
REACH = 0.97


@dataclass
class Codes:
    """code = signs of (vector - mean) @ turn; radius reaches REACH of the true neighbours in the sample."""

    mean: np.ndarray
    turn: np.ndarray
    radius: int

    def of(self, x: np.ndarray) -> np.ndarray:
        bits = (x - self.mean) @ self.turn > 0
        out = np.zeros((len(x), 8), np.uint8)
        packed = np.packbits(bits, 1, "little")
        out[:, : packed.shape[1]] = packed
        return out.view(np.uint64)[:, 0]


def learn(x: np.ndarray, rounds: int = 30, seed: int = 5) -> Codes:
    """Principal directions, then the rotation that brings their values closest to their signs (iterative quantisation)."""
    bits = min(BITS, x.shape[1])
    mean = x.mean(0)
    _, _, directions = np.linalg.svd(x - mean, full_matrices=False)
    directions = directions[:bits].T
    v = (x - mean) @ directions
    turn = np.linalg.qr(np.random.default_rng(seed).normal(size=(v.shape[1], v.shape[1])))[0]
    for _ in range(rounds):
        left, _, right = np.linalg.svd(np.where(v @ turn > 0, 1.0, -1.0).T @ v)
        turn = (left @ right).T
    codes = Codes(mean, directions @ turn, bits)
    code = codes.of(x)
    far = []
    for i in range(0, len(x), max(1, len(x) // 200)):
        d = ((x - x[i]) ** 2).sum(1)
        d[i] = np.inf
        k = min(NEAREST, len(x) - 1)
        if k:
            far += np.bitwise_count(code[np.argpartition(d, k - 1)[:k]] ^ code[i]).tolist()
    codes.radius = int(np.quantile(far, REACH, method="higher")) if far else bits
    return codes


class Index:
    """The codes' substrings, each sorted: a code within ``radius`` of another agrees with it in some substring up to radius // substrings bits."""

    def __init__(self, code: np.ndarray) -> None:
        self.code = code
        self.parts = []
        for k in range(BITS // SUBSTRING):
            part = self._part(code, k)
            order = np.argsort(part, kind="stable")
            values, starts = np.unique(part[order], return_index=True)
            self.parts.append((order, values, np.append(starts, len(part))))

    @staticmethod
    def _part(code: np.ndarray, k: int) -> np.ndarray:
        return ((code >> np.uint64(SUBSTRING * k)) & np.uint64((1 << SUBSTRING) - 1)).astype(np.uint16)

    def within(self, query: np.uint64, radius: int) -> np.ndarray:
        """All places whose code is within the radius."""
        near = radius // len(self.parts)
        found = np.zeros(len(self.code), bool)
        for k, (order, values, starts) in enumerate(self.parts):
            own = np.uint16((int(query) >> (SUBSTRING * k)) & ((1 << SUBSTRING) - 1))
            hit = np.bitwise_count(values ^ own) <= near
            found[order[np.repeat(hit, np.diff(starts))]] = True
        at = np.flatnonzero(found)
        return at[np.bitwise_count(self.code[at] ^ query) <= radius]


def usable(rows: DataFrame, vec_id: str, vector: str) -> DataFrame:
    """(v, ids, queries) of rows with an id and a vector (binary of doubles) that isn't null, empty or zero and has no null or non-finite part; equal vectors of a batch are one."""
    v = F.col(vector).cast("array<double>")
    good = F.col(vec_id).isNotNull() & v.isNotNull() & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists(v, lambda x: x != 0)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Of equal vectors in a batch only the smallest ids can be near anything: NEAREST and the query's own."""
        for b in batches:
            held: dict[bytes, list[int]] = {}
            for i, x in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                held.setdefault((np.array(x, np.float64) + 0.0).tobytes(), []).append(i)  # -0 is 0
            yield pa.RecordBatch.from_arrays([pa.array(list(held), pa.binary()), pa.array([sorted(x)[: NEAREST + 1] for x in held.values()], pa.list_(pa.int64())), pa.array([[i for i in x if i % 100 == 0] for x in held.values()], pa.list_(pa.int64()))], names=["v", "ids", "queries"])

    return rows.where(good).select(F.col(vec_id).cast("long"), v.alias("v")).mapInArrow(run, "v binary, ids array<long>, queries array<long>")


def distinct_vectors(partial: DataFrame) -> DataFrame:
    """(v, ids): different vectors with their NEAREST + 1 smallest ids; the copies of a very common one are brought down in SALTS groups first."""
    smallest = F.slice(F.array_sort(F.flatten(F.collect_list("ids"))), 1, NEAREST + 1).alias("ids")
    salted = partial.withColumn("salt", F.pmod(F.xxhash64("ids"), F.lit(SALTS)))
    return salted.groupBy("v", "salt").agg(smallest).groupBy("v").agg(smallest)


def search(rows: DataFrame, vec_id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score): for each row whose id is divisible by 100 the NEAREST nearest other rows found, by Euclidean distance.

    Vectors that are null, empty, zero or hold null or non-finite parts take no part; others meet those of their own length. Ties go
    to the smaller id. Equal vectors are one in the index, with their smallest ids, so that copies neither crowd it nor are lost; a
    vector is looked up once, whatever number of queries it has. Codes are for the commonest length (the smallest of those, if
    several); vectors of other lengths are compared without an index. Each query vector is held against all vectors, in blocks of BASE
    by QUERIES; where the radius finds under NEAREST rows in a block, it grows. No usable vector: no rows.
    """
    spark = rows.sparkSession
    partial = stored(usable(rows, vec_id, vector))
    vectors = stored(distinct_vectors(partial).withColumns({"h": F.xxhash64("v"), "n": F.length("v")}))
    lengths = vectors.groupBy("n").count().orderBy(F.desc("count"), "n").first()
    if lengths is None:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    sample = vectors.where(F.col("n") == lengths["n"]).select("h", "v").orderBy("h", "v").limit(SAMPLE).toArrow()
    codes = learn(np.stack([np.frombuffer(v, np.float64) for v in sample.column("v").to_pylist()]))
    asked = partial.where(F.size("queries") > 0).select("v", F.explode("queries").alias("query_id"))
    different = stored(asked.select("v").distinct().withColumns({"h": F.xxhash64("v"), "n": F.length("v")}))
    parts, blocks = -(-vectors.count() // BASE), -(-max(1, different.count()) // QUERIES)
    by = lambda k, salt: F.pmod(F.xxhash64("h", F.lit(salt)), F.lit(k)).cast("int")
    base = vectors.select("v", "ids", "n", by(parts, 1).alias("part"), F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"))
    queries = different.select("v", "n", by(blocks, 2).alias("block"), F.explode(F.sequence(F.lit(0), F.lit(parts - 1))).alias("part"))

    def cell(left: pa.Table, right: pa.Table) -> pa.Table:
        out: list[tuple[bytes, int, float]] = []
        if len(left) and len(right):
            x = np.stack([np.frombuffer(v, np.float64) for v in left.column("v").to_pylist()])
            ids = left.column("ids").to_pylist()
            raw = right.column("v").to_pylist()
            q = np.stack([np.frombuffer(v, np.float64) for v in raw])
            coded = x.shape[1] == len(codes.mean)
            index = Index(codes.of(x)) if coded else None
            for v, vec, code in zip(raw, q, codes.of(q) if coded else [None] * len(q), strict=True):
                at, radius = np.arange(len(x)), codes.radius
                while coded:
                    at = index.within(code, radius)
                    if len(at) > NEAREST or radius >= BITS:  # one may be the query's own
                        break
                    radius += 4
                d = np.sqrt(((x[at] - vec) ** 2).sum(1))
                least = np.partition(d, NEAREST)[NEAREST] if len(d) > NEAREST else np.inf
                found = sorted((float(d[i]), c) for i in np.flatnonzero(d <= least) for c in ids[at[i]])
                out += [(v, c, s) for s, c in found[: NEAREST + 1]]
        return pa.table({"v": pa.array([o[0] for o in out], pa.binary()), "vec_id": pa.array([o[1] for o in out], pa.int64()), "score": pa.array([o[2] for o in out], pa.float64())})

    met = base.groupBy("n", "part", "block").cogroup(queries.groupBy("n", "part", "block")).applyInArrow(cell, "v binary, vec_id long, score double")
    top = lambda key: F.row_number().over(W.partitionBy(key).orderBy("score", "vec_id"))
    best = met.withColumn("place", top("v")).where(F.col("place") <= NEAREST + 1).drop("place")
    best = best.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    both = asked.withColumn("salt", F.pmod(F.xxhash64("query_id"), F.lit(SALTS)).cast("int")).join(best, ["v", "salt"]).where("vec_id <> query_id")
    return both.withColumn("rank", top("query_id")).where(F.col("rank") <= NEAREST).select("query_id", "rank", "vec_id", "score")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search(table(spark, sf_dir, "embeddings").select("vec_id", "embedding"))
