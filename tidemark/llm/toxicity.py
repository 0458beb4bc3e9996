"""Toxicity: maximum-scoring segments of token log-odds, with extreme-value calibration."""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import repeat

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import fit_logistic, fold, forget, map_rows, stored, table, utf8
from tidemark.llm.rules import sampled_labels

#: Labelled rows that the model is learned from, at most: those with the smallest hash of their id.
SAMPLE = 40_000
TOKEN = re.compile(rb"[a-z\x80-\xff]+")
#: Weight of the Dirichlet prior, in tokens, and standard errors that a log-odds must be from 0 to count.
PRIOR, ERRORS = 500.0, 4.0
#: Uses in toxic texts that also tell a token without any in clean ones, if its log-odds are that high.
ALONE, HIGH = 8, 3.0
#: Best segments of a labelled row that the calibration is fitted on; scoring counts all.
MOST = 50


def segments(scores: np.ndarray) -> list[tuple[int, int, float]]:
    """All maximal scoring segments (start, end, score) of a text's token scores, in linear time.

    Each candidate keeps the running sum before it and at its end; a token that scores above 0 opens one, which joins the nearest
    earlier candidate that starts lower, if that ends lower too, and what lies between.
    """
    open_: list[tuple[int, int, float, float]] = []  # start, end, sum before, sum at end
    lower: list[int] = []  # for each candidate, the nearest earlier one whose sum before is smaller
    places = np.flatnonzero(scores > 0)
    sums = np.concatenate([[0.0], np.cumsum(scores)])
    for place, before, after in zip(places.tolist(), sums[places].tolist(), sums[places + 1].tolist(), strict=True):
        start, end = place, place + 1
        while True:
            j = len(open_) - 1
            while j >= 0 and open_[j][2] >= before:
                j = lower[j]
            if j < 0 or open_[j][3] >= after:
                open_.append((start, end, before, after))
                lower.append(j)
                break
            start, before = open_[j][0], open_[j][2]
            del open_[j:], lower[j:]
    return [(s, e, b - a) for s, e, a, b in open_]


@dataclass
class Model:
    score: dict[bytes, float]  # of tokens whose log-odds are told from 0; all others have 0
    drift: float  # taken off every token
    scale: float  # lambda of the extreme-value law
    chance: float  # K of the extreme-value law
    weights: np.ndarray  # of the calibration: constant, evidence of the best segment, of all significant ones

    def passages(self, raw: bytes) -> tuple[list[tuple[int, int, float]], int]:
        tokens = TOKEN.findall(raw.lower())
        scores = np.fromiter(map(self.score.get, tokens, repeat(0.0)), float, len(tokens))
        return segments(scores - self.drift), len(tokens)

    def evidence(self, raw: bytes) -> tuple[float, float, list[tuple[int, int, float]]]:
        """-log E of the best segment, the sum over those with E < 1, and these as (start, end, -log E) in bytes of the text."""
        found, n = self.passages(raw)
        best, total, _ = self.weigh([s[2] for s in found], n)
        if not best:
            return best, total, []
        places = [m.span() for m in TOKEN.finditer(raw.lower())]
        least = math.log(self.chance * max(n, 1))
        return best, total, [(places[a][0], places[b - 1][1], x) for a, b, s in found if (x := self.scale * s - least) > 0]

    def weigh(self, scores: list[float], n: int) -> tuple[float, float, int]:
        least = [x for s in scores if (x := self.scale * s - math.log(self.chance * max(n, 1))) > 0]
        return (max(least, default=0.0), sum(least), len(least))

    def value(self, best: float, total: float) -> float:
        z = float(self.weights @ np.array([1.0, math.log1p(best), math.log1p(total)]))
        return 1 / (1 + math.exp(-max(-40.0, min(40.0, z))))


def log_odds(counted: DataFrame, n1: int, n0: int, prior: float = PRIOR, errors: float = ERRORS) -> DataFrame:
    """(token, toxic, clean, score) of every token: its log-odds, above 0 or below, under a Dirichlet prior in proportion to all counts; 0 if that is within ``errors`` standard errors."""
    a = prior * (F.col("toxic") + F.col("clean")) / float(n1 + n0)
    hi, lo = F.col("toxic") + a, F.col("clean") + a
    delta = F.log(hi / (n1 + prior - hi)) - F.log(lo / (n0 + prior - lo))
    told = (F.abs(delta) >= errors * F.sqrt(1 / hi + 1 / lo)) | ((F.col("toxic") >= ALONE) & (F.col("clean") == 0) & (delta >= HIGH))
    return counted.withColumn("score", F.when(told, delta).otherwise(0.0))


def chance_law(tokens: list[tuple[int, float]], n0: int) -> tuple[float, float]:
    """(drift, lambda): what is taken off each token so that clean texts lose by chance, and the root of sum of p exp(lambda s) = 1 over them.

    tokens: (uses in clean texts, score) of those whose score isn't 0.
    """
    n0 = max(n0, 1)
    p = np.array([(c + 1 / max(len(tokens), 1)) / n0 for c, _ in tokens])
    s = np.array([x for _, x in tokens])
    drift = max(0.05, 4 * float(p[s > 0] @ s[s > 0])) if len(s) else 1.0
    lo, hi = 1e-6, 50.0
    for _ in range(80):
        mid = (lo + hi) / 2
        grown = float(p @ np.exp(np.clip(mid * (s - drift), -700, 700))) + max(0.0, 1 - p.sum()) * math.exp(-mid * drift) if len(s) else 0.0
        lo, hi = (mid, hi) if grown < 1 else (lo, mid)
    return drift, lo


def token_counts(texts: DataFrame) -> DataFrame:
    """(token, toxic, clean) counts from rows (text binary, toxic int); each task sums what it can before the shuffle."""

    def rows(docs: Iterator[tuple]) -> Iterator[tuple]:
        held = (Counter(), Counter())
        for raw, y in docs:
            held[y].update(TOKEN.findall(raw.lower()))
            if len(held[0]) + len(held[1]) > 200_000:
                for k in (0, 1):
                    yield from ((w, n * k, n * (1 - k)) for w, n in held[k].items())
                    held[k].clear()
        for k in (0, 1):
            yield from ((w, n * k, n * (1 - k)) for w, n in held[k].items())

    return map_rows(texts, rows, "token binary, toxic long, clean long", chunk=20_000).groupBy("token").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))


def learn_from(docs: DataFrame, labels: DataFrame, most: int = SAMPLE, allowed=None) -> Model:
    """The model of at most ``most`` labelled rows; equal texts count once. With one kind of label, nothing is found toxic.

    To the driver go the tokens of the sample whose log-odds are told from 0, toxic and clean ones, and what the passages of each
    sampled row come to. Equal counts give equal scores.
    """
    labels = labels.where(allowed) if allowed is not None else labels
    sample = F.broadcast(sampled_labels(labels, "toxic", most))  # at most ``most`` rows
    texts = docs.join(sample, F.col("doc_id") == F.col("_tm_id")).select(utf8("text").alias("text"), (F.col("_tm_label") > 0).cast("int").alias("toxic"))
    texts = stored(texts.withColumn("_h", F.sha2("text", 256)).groupBy("_h").agg(F.first("text").alias("text"), F.max("toxic").alias("toxic")).drop("_h"))
    counted = stored(token_counts(texts))
    n1, n0 = counted.agg(F.coalesce(F.sum("toxic"), F.lit(0)), F.coalesce(F.sum("clean"), F.lit(0))).first()
    if not n1 or not n0:
        return Model({}, 1.0, 1.0, 1.0, np.array([-5.0 if n0 or not n1 else 5.0, 0, 0]))
    told = log_odds(counted, n1, n0).where("score <> 0").orderBy("token").toArrow()
    scores = dict(zip(told.column("token").to_pylist(), told.column("score").to_pylist(), strict=True))
    drift, scale = chance_law(list(zip(told.column("clean").to_pylist(), scores.values(), strict=True)), n0)
    model = Model(scores, drift, scale, 1.0, np.zeros(3))

    def rows(docs: Iterator[tuple]) -> Iterator[tuple]:
        for raw, y in docs:
            found, n = model.passages(raw)
            yield y, n, sorted((s[2] for s in found), reverse=True)[:MOST]

    got = map_rows(texts, rows, "toxic int, n long, scores array<double>").toArrow()
    got = sorted(zip(*(c.to_pylist() for c in got.columns), strict=True))
    forget(texts, counted)
    # the mean of an extreme-value law: (log K + Euler's constant) / lambda, after the length is taken off
    peaks = [max(r[2], default=0.0) * scale - math.log(max(r[1], 1)) for r in got if not r[0]]
    model.chance = float(np.clip(math.exp(np.mean(peaks) - 0.5772), 1e-6, 1))
    ev = np.array([model.weigh(r[2], r[1])[:2] for r in got])
    model.weights = fit_logistic(np.column_stack([np.ones(len(ev)), np.log1p(ev)]), np.array([float(r[0]) for r in got]))
    return model


def scored(docs: DataFrame, model: Model, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, score, n_passages, evidence, passages) of every row: passages are the significant ones, in order, as (start, end, -log E) in bytes.

    Null and empty texts have no passage and the lowest score; rows that repeat score alike; of segments that could be drawn in several
    ways with one score the shortest and first is taken.
    """
    sent = docs.sparkSession.sparkContext.broadcast(model)  # tokens of SAMPLE texts at most

    def rows(docs: Iterator[tuple]) -> Iterator[tuple]:
        model = sent.value
        for key, raw in docs:
            best, total, found = model.evidence(raw)
            yield key, model.value(best, total), len(found), best, [{"start": a, "end": b, "evidence": x} for a, b, x in found]

    kind = docs.schema[doc_id].dataType.simpleString()
    inputs = docs.select(F.col(doc_id).alias("doc_id"), utf8(text).alias("text"))
    return map_rows(inputs, rows, f"doc_id {kind}, score double, n_passages long, evidence double, passages array<struct<start:bigint,end:bigint,evidence:double>>")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    model = learn_from(docs, labels, allowed=fold("doc_id", 4) != 2)
    return scored(docs, model).select("doc_id", (fold("doc_id", 4) == 2).alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"), "n_passages", "evidence")
