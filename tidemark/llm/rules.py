"""Quality rules: a decision list of threshold conjunctions, learned by sequential covering, emitted as Spark expressions."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import map_rows, table, utf8
from tidemark.llm.stats import FEATURES, NAMES, features, text_stats

#: Labelled rows that a list is learned from, at most: those with the smallest hash of their id.
SAMPLE = 20_000


@dataclass(frozen=True)
class Test:
    """feature >= at, or feature < at."""

    feature: int
    above: bool
    at: float

    def holds(self, x: np.ndarray) -> np.ndarray:
        return (x[:, self.feature] >= self.at) == self.above

    def expression(self) -> Column:
        c = FEATURE_COLUMNS[FEATURES[self.feature]]()
        return c >= self.at if self.above else c < self.at

    def __str__(self) -> str:
        return f"{FEATURES[self.feature]} {'>=' if self.above else '<'} {self.at:.4g}"


Rule = tuple[Test, ...]


def covers(rule: Rule, x: np.ndarray) -> np.ndarray:
    out = np.ones(len(x), bool)
    for t in rule:
        out &= t.holds(x)
    return out


def best_test(x: np.ndarray, bad: np.ndarray, cuts: int) -> tuple[float, Test | None]:
    """The test with the highest FOIL gain over the rows so far."""
    p0, n0 = bad.sum(), (~bad).sum()
    best: tuple[float, Test | None] = (0.0, None)
    if not p0 or not n0:
        return best
    info = np.log2(p0 / (p0 + n0))
    for f in range(x.shape[1]):
        v = x[:, f]
        at = np.unique(np.concatenate([np.quantile(v, np.linspace(0, 1, cuts), method="nearest"), np.quantile(v[bad], np.linspace(0, 1, cuts), method="nearest")]))
        order = np.argsort(v, kind="stable")
        sums = np.concatenate([[0], np.cumsum(bad[order])])
        below = np.searchsorted(v[order], at, "left")
        p_low = sums[below]
        for above, p, n in ((False, p_low, below - p_low), (True, p0 - p_low, (len(v) - below) - (p0 - p_low))):
            with np.errstate(divide="ignore", invalid="ignore"):
                gain = np.where(p > 0, p * (np.log2(p / np.maximum(p + n, 1)) - info), 0)
            k = int(np.argmax(gain))
            if gain[k] > best[0] + 1e-9:
                best = float(gain[k]), Test(f, above, float(at[k]))
    return best


def learn(x: np.ndarray, bad: np.ndarray, rules: int = 12, tests: int = 4, cuts: int = 48, precision: float = 0.7, least: int = 5) -> list[Rule]:
    """An ordered list of rules, each of which says "bad"; what none covers is good.

    A rule grows on two thirds of the rows that no earlier rule covers, by the test of highest FOIL gain, until it covers no good
    row; the other third then cuts its last tests as long as (bad - good) / (bad + good) doesn't fall. Learning ends when a rule's
    precision there (Laplace) is under ``precision``, or it covers under ``least`` bad rows. No or one-sided labels: no rules.
    """
    out: list[Rule] = []
    left = np.ones(len(x), bool)
    prune = np.arange(len(x)) % 3 == 2
    while len(out) < rules and bad[left].sum() >= least:
        gx, gb = x[left & ~prune], bad[left & ~prune]
        rule: list[Test] = []
        inside = np.ones(len(gx), bool)
        while len(rule) < tests and (~gb[inside]).any():
            gain, test = best_test(gx[inside], gb[inside], cuts)
            if test is None:
                break
            rule.append(test)
            inside &= test.holds(gx)
        px, pb = x[left & prune], bad[left & prune]

        def worth(r: Rule) -> float:
            c = covers(r, px)  # noqa: B023
            p, n = pb[c].sum(), (~pb[c]).sum()  # noqa: B023
            return (p - n) / max(p + n, 1)

        while len(rule) > 1 and worth(tuple(rule[:-1])) >= worth(tuple(rule)):
            rule.pop()
        c = covers(tuple(rule), x) & left
        held = c & prune
        p, n = bad[held].sum(), (~bad[held]).sum()
        if not rule or bad[c].sum() < least or (p + 1) / (p + n + 2) < precision:
            break
        out.append(tuple(rule))
        left &= ~c
    return out


def _ratio(a: str, b: str):
    return lambda: F.col(a) / F.greatest(F.col(b), F.lit(1))


#: FEATURES as expressions over the columns NAMES.
FEATURE_COLUMNS = {
    "words": lambda: F.col("n_words").cast("double"), "chars_a_word": _ratio("word_chars", "n_words"), "symbols_a_word": _ratio("n_symbols", "n_words"), "dup_lines": _ratio("n_dup_lines", "n_lines"), "repeated_words": _ratio("n_repeat_words", "n_words"),
    "words_a_line": _ratio("n_words", "n_lines"), "upper": _ratio("n_upper", "word_chars"), "digits": _ratio("n_digits", "word_chars"), "exclaims_a_word": _ratio("n_exclaims", "n_words"), "distinct": _ratio("n_distinct", "n_words"),
}


def decision(rules: list[Rule]) -> Column:
    """The list as one ordered conditional: the number of the first rule that holds, null if none does."""
    out = None
    for i, rule in enumerate(rules):
        c = rule[0].expression()
        for t in rule[1:]:
            c = c & t.expression()
        out = F.when(c, i) if out is None else out.when(c, i)
    return F.lit(None).cast("int") if out is None else out.cast("int")


def with_stats(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, NAMES) of every row; a null text counts as empty."""

    def rows(docs: Iterator[tuple]) -> Iterator[tuple]:
        for key, raw in docs:
            yield key, *text_stats(raw)

    kind = docs.schema[doc_id].dataType.simpleString()
    return map_rows(docs.select(F.col(doc_id).alias("doc_id"), utf8(text).alias("text")), rows, f"doc_id {kind}, " + ", ".join(f"{n} long" for n in NAMES))


def sampled_labels(labels: DataFrame, column: str, most: int, doc_id: str = "doc_id") -> DataFrame:
    """At most ``most`` labelled rows (doc_id, label 0 or 1), those with the smallest hash of their id; rows with nulls are left out."""
    rows = labels.where(F.col(doc_id).isNotNull() & F.col(column).isNotNull()).select(F.col(doc_id).alias("_tm_id"), F.col(column).cast("int").alias("_tm_label"))
    return rows.orderBy(F.xxhash64("_tm_id"), "_tm_id", "_tm_label").limit(most)


def learn_from(docs: DataFrame, labels: DataFrame, most: int = SAMPLE) -> list[Rule]:
    sample = F.broadcast(sampled_labels(labels, "quality", most))  # at most ``most`` rows
    joined = docs.join(sample, F.col("doc_id") == F.col("_tm_id"))
    got = with_stats(joined.select("doc_id", "text")).join(sample, F.col("doc_id") == F.col("_tm_id")).drop("_tm_id")
    rows = got.orderBy(F.xxhash64("doc_id"), *got.columns).toPandas()
    if not len(rows):
        return []
    return learn(features(rows[list(NAMES)].to_numpy()), rows["_tm_label"].to_numpy() == 0)


def judged(docs: DataFrame, rules: list[Rule]) -> DataFrame:
    """Statistics, base_failed, the rule that rejects the row (null: none) and kept, for every row of docs.

    kept is false if base_failed (fewer than 50 words, or more than half of them in repeated windows), else what the list says.
    Null and empty texts have no words and fail. Rows that repeat are judged alike; other columns of docs are not read.
    """
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    out = with_stats(docs).withColumn("base_failed", failed).withColumn("rule", decision(rules))
    return out.withColumn("kept", ~F.col("base_failed") & F.col("rule").isNull())


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    return judged(docs, learn_from(docs, labels)).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "rule")
