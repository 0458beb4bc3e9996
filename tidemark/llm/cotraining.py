"""Quality classifier by co-training: a text view and a metadata view teach each other, then their calibrated scores are combined."""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import fit_logistic, forget, hand_back, map_rows, sigmoid, stored, summed, table, utf8
from tidemark.llm.hashing import word_hashes
from tidemark.llm.rules import sampled_labels
from tidemark.llm.stats import FEATURES, features, text_stats

#: Labelled rows that the views learn from, at most: those with the smallest hash of their id.
SAMPLE = 20_000
#: Hashed cells of a text's words, and of each metadata column.
WORDS, CELLS = 128, 64
TEXT, META = 1 + 2 * len(FEATURES) + WORDS, 1 + 2 * CELLS
#: Rounds of co-training; in each a view labels ``SHARE`` more of all unlabelled rows, those it is surest of, from a probability of SURE on.
ROUNDS, SHARE, SURE = 3, 0.1, 0.9
#: Steps in which sureness is counted, and what a taught row weighs beside a labelled one.
STEPS, TAUGHT = 1000, 0.5
#: Labelled rows that the driver takes as doubles at once; it holds all of them as they were sent, in one copy.
ROWS = 1000
#: Rows with this score or more are kept.
KEEP = 0.3


def text_features(raw: bytes) -> np.ndarray:
    """Of one text: statistics on bounded scales with their squares, and its words' shares in hashed cells; no metadata."""
    x = features([text_stats(raw)])[0]
    x[0] = np.log1p(x[0]) / 10
    x[1] = min(x[1], 40) / 10
    x[5] = np.log1p(x[5]) / 5
    x = np.minimum(x, 4)
    hashes = word_hashes(raw)
    cells = np.sqrt(np.bincount((hashes >> np.uint64(9)).astype(np.int64) % WORDS, minlength=WORDS) / max(1, len(hashes)))
    return np.concatenate([[1.0], x, x * x, cells])


def metadata_cells(lang: str | None, source: str | None) -> bytes:
    """Hashed language and source, a cell each; nulls have cells of their own. Nothing that the text says, not even its length."""
    return bytes(0 if v is None else 1 + zlib.crc32(v.encode()) % (CELLS - 1) for v in (lang, source))


@dataclass
class Metadata:
    """The metadata view of rows, held as their cells [row, column]; a slice gives its features: ones, and 1 at each cell."""

    cells: np.ndarray

    @property
    def shape(self) -> tuple[int, int]:
        return len(self.cells), META

    def __len__(self) -> int:
        return len(self.cells)

    def __getitem__(self, rows: slice) -> np.ndarray:
        cells = self.cells[rows].astype(int)
        out = np.zeros((len(cells), META))
        out[:, 0] = 1
        for k in range(2):
            out[np.arange(len(cells)), 1 + k * CELLS + cells[:, k]] = 1
        return out


Views = tuple[np.ndarray, Metadata]


def views_of(texts: list[bytes], cells: list[bytes]) -> Views:
    """Both views of rows from their text features and metadata cells as bytes."""
    n = len(texts)
    return np.frombuffer(b"".join(texts), np.float32).reshape(n, TEXT), Metadata(np.frombuffer(b"".join(cells), np.uint8).reshape(n, 2))


@dataclass
class View:
    weights: np.ndarray
    slope: float = 1.0
    shift: float = 0.0

    def log_odds(self, x: np.ndarray) -> np.ndarray:
        return self.slope * (x @ self.weights) + self.shift


@dataclass
class Model:
    text: View
    metadata: View
    prior: float

    def score(self, text: np.ndarray, metadata: np.ndarray) -> np.ndarray:
        """Views are taken as independent given the class: their log-odds add up, less the prior counted twice."""
        return sigmoid(self.text.log_odds(text) + self.metadata.log_odds(metadata) - self.prior)


def _parts(x: np.ndarray | Metadata) -> Iterator[tuple[slice, np.ndarray]]:
    """ROWS rows after another, as doubles."""
    for at in range(0, len(x), ROWS):
        yield slice(at, at + ROWS), np.asarray(x[at : at + ROWS], float)


def calibrated(view: View, x: np.ndarray | Metadata, y: np.ndarray) -> View:
    z = np.concatenate([part @ view.weights for _, part in _parts(x)])
    shift, slope = fit_logistic(np.column_stack([np.ones(len(z)), z]), y, ridge=1e-4)
    return View(view.weights, float(max(slope, 0)), float(shift))


def _batches(rows: Iterator[tuple], most: int = 2000) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Both views of rows (text features, metadata cells as bytes), many at a time, as doubles."""
    held: list[tuple] = []
    for row in rows:
        held.append(row)
        if len(held) == most:
            yield tuple(np.asarray(v[:], float) for v in views_of(*zip(*held, strict=True)))
            held = []
    if held:
        yield tuple(np.asarray(v[:], float) for v in views_of(*zip(*held, strict=True)))


def sureness(pool: DataFrame, views: tuple[View, View]) -> np.ndarray:
    """[view, class, step]: how many rows of the pool each view gives to each class with that sureness."""

    def rows(found: Iterator[tuple]) -> Iterator[tuple]:
        counts = np.zeros((2, 2, STEPS))
        for x in _batches(found):
            for k, view in enumerate(views):
                p = sigmoid(view.log_odds(x[k]))
                for label, sure in ((1, p), (0, 1 - p)):
                    counts[k, label] += np.bincount(np.minimum((sure * STEPS).astype(int), STEPS - 1), minlength=STEPS)
        yield 0, 0, counts.tobytes()

    got = summed(map_rows(pool, rows, "k int, n long, blob binary"))
    return got[0].reshape(2, 2, STEPS) if got else np.zeros((2, 2, STEPS))


def newton(pool: DataFrame, views: tuple[View, View], teachers: tuple[View, View], least: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each view, gradient and Hessian of the logistic loss over all rows of the pool that its teacher, the other view, labels: those with a sureness step of least[teacher, class] or more."""

    def rows(found: Iterator[tuple]) -> Iterator[tuple]:
        total = [(np.zeros(d), np.zeros((d, d))) for d in (TEXT, META)]
        for x in _batches(found):
            for k, (g, h) in enumerate(total):
                p = sigmoid(teachers[1 - k].log_odds(x[1 - k]))
                step = lambda sure: np.minimum((sure * STEPS).astype(int), STEPS - 1)
                up, down = step(p) >= least[1 - k, 1], step(1 - p) >= least[1 - k, 0]
                at = np.flatnonzero(up | down)
                own, y = x[k][at], (up & (p >= 0.5))[at].astype(float)
                q = sigmoid(own @ views[k].weights)
                g += TAUGHT * (own.T @ (q - y))
                h += TAUGHT * ((own * (q * (1 - q))[:, None]).T @ own)
        for k, (g, h) in enumerate(total):
            yield k, 0, np.concatenate([g, h.reshape(-1)]).tobytes()

    got = summed(map_rows(pool, rows, "k int, n long, blob binary"))
    out = []
    for k, d in enumerate((TEXT, META)):
        x = got.get(k, np.zeros(d + d * d))
        out.append((x[:d], x[d:].reshape(d, d)))
    return out


def thresholds(counts: np.ndarray, rate: float, share: float, sure: float = SURE) -> np.ndarray:
    """[view, class]: the step from which on a view is sure enough: ``share`` of all rows at most, each class in proportion to its prior."""
    least = np.empty((2, 2), int)
    for k in range(2):
        total = counts[k, 1].sum()
        for label, part in ((1, rate), (0, 1 - rate)):
            above = np.cumsum(counts[k, label][::-1])[::-1]
            fits = np.flatnonzero(above <= max(1.0, share * part * total))
            least[k, label] = max(int(sure * STEPS), int(fits[0]) if len(fits) else STEPS - 1)
    return least


def learn(own: Views, y: np.ndarray, pool: DataFrame, ridge: float = 1e-3) -> Model:
    """Co-training from labelled rows (their two views, y) and all unlabelled rows (t, m: text features and metadata cells).

    A third of the labelled rows is kept for calibration. In each round each view labels anew the pool rows that it is surest of, a
    share that grows from round to round, and the other view learns from them by Newton steps, whose sums Spark makes over the whole
    pool. No labels of one class: the score is the prior.
    """
    rate = float((y.sum() + 1) / (len(y) + 2))
    prior = float(np.log(rate / (1 - rate)))
    if not len(y) or y.min() == y.max():
        return Model(*(View(np.zeros(d), 1.0, prior) for d in (TEXT, META)), prior)
    held = np.arange(len(y)) % 3 == 2 if len(y) >= 60 else np.zeros(len(y), bool)
    order = np.argsort(held, kind="stable")  # those kept for calibration come last, so that both parts are slices
    n = len(y) - int(held.sum())
    y = y[order]
    own = own[0][order], Metadata(own[1].cells[order])
    at = slice(n, None) if held.any() and 0 < y[n:].mean() < 1 else slice(0, n)
    x, t = (own[0][:n], Metadata(own[1].cells[:n])), y[:n]
    c = own[0][at], Metadata(own[1].cells[at])
    views = [calibrated(View(fit_logistic(v, t, ridge=ridge, rows=ROWS)), w, y[at]) for v, w in zip(x, c, strict=True)]
    for turn in range(ROUNDS):
        teachers = tuple(views)
        least = thresholds(sureness(pool, teachers), rate, SHARE * (turn + 1))
        for _ in range(2):
            for k, (g, h) in enumerate(newton(pool, tuple(views), teachers, least)):
                w = views[k].weights
                for s, part in _parts(x[k]):
                    p = sigmoid(part @ w)
                    g = g + part.T @ (p - t[s])
                    h = h + (part * (p * (1 - p))[:, None]).T @ part
                g, h = g + ridge * len(t) * w, h + (ridge * len(t) + 1e-6) * np.eye(len(w))
                step = np.linalg.solve(h, g)
                views[k] = replace(views[k], weights=w - step * min(1.0, 5 / max(np.abs(step).max(), 1e-9)))
        views = [calibrated(v, w, y[at]) for v, w in zip(views, c, strict=True)]
    return Model(*views, prior)


def _inputs(docs: DataFrame, *more: str | Column) -> DataFrame:
    return docs.select(*more, utf8("text").alias("_tm_text"), F.col("lang").cast("string").alias("_tm_lang"), F.col("source").cast("string").alias("_tm_source"))


def labelled(got: pa.Table) -> tuple[Views, np.ndarray]:
    """Both views and y of rows (doc_id, y, t, m), in an order that depends on them only: by a hash of the id, rows that share an id by their views.

    Features are copied once, from Arrow's buffers, and no object is made for a row's: the driver holds little beside them, and can
    give it back.
    """
    text, cells = np.empty((got.num_rows, TEXT), np.float32), np.empty((got.num_rows, 2), np.uint8)
    for k, into in ((2, text), (3, cells)):
        at = 0
        for chunk in got.column(k).chunks:
            for i, value in enumerate(chunk):
                into[at + i] = np.frombuffer(value.as_buffer(), into.dtype)
            at += len(chunk)
    ids = [str(x) for x in got.column(0).to_pylist()]
    times = Counter(ids)
    more = lambda i: (text[i].tobytes(), Metadata(cells[i : i + 1])[:].astype(np.float32).tobytes()) if times[ids[i]] > 1 else ()
    order = sorted(range(len(ids)), key=lambda i: (zlib.crc32(ids[i].encode()), ids[i], more(i)))
    y = np.array([float(v > 0) for v in got.column(1).to_pylist()])
    return (text[order], Metadata(cells[order])), y[order]


def learn_from(docs: DataFrame, labels: DataFrame, most: int = SAMPLE) -> Model:
    """The model of at most ``most`` labelled rows and all others, whose features are written once; only labelled ones go to the driver."""
    label = F.broadcast(sampled_labels(labels, "quality", most))  # at most ``most`` rows

    def rows(docs: Iterator[tuple]) -> Iterator[tuple]:
        for key, y, raw, *meta in docs:
            yield key, y, text_features(raw).astype(np.float32).tobytes(), metadata_cells(*meta)

    all_ = docs.join(label, F.col("doc_id") == F.col("_tm_id"), "left")
    seen = stored(map_rows(_inputs(all_, "doc_id", F.col("_tm_label").cast("int").alias("y")), rows, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, y int, t binary, m binary"))
    own, y = labelled(seen.where("y is not null").toArrow())
    hand_back()
    model = learn(own, y, seen.where("y is null").select("t", "m"))
    forget(seen)
    del own
    hand_back()
    return model


def scored(docs: DataFrame, model: Model) -> DataFrame:
    """docs with _tm_score: the probability of good quality, for every row.

    Null and empty texts have statistics of 0 and no words; nulls in lang and source have cells of their own; rows that repeat score
    alike, and a tie at the bound is kept.
    """

    def rows(found: Iterator[tuple]) -> Iterator[tuple]:
        held: list[tuple] = []
        views: list[tuple] = []

        def done() -> Iterator[tuple]:
            texts, cells = zip(*views, strict=True)
            for row, p in zip(held, model.score(np.stack(texts), Metadata(np.frombuffer(b"".join(cells), np.uint8).reshape(-1, 2))[:]), strict=True):
                yield *row, float(p)
            held.clear()
            views.clear()

        for *own, raw, lang, source in found:
            held.append(tuple(own))
            views.append((text_features(raw), metadata_cells(lang, source)))
            if len(held) == 500:
                yield from done()
        if held:
            yield from done()

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema)
    return map_rows(_inputs(docs, *docs.columns), rows, f"{fields}, _tm_score double", chunk=200)


def accepted(docs: DataFrame, labels: DataFrame, least: float = KEEP) -> DataFrame:
    """The rows of docs that score ``least`` or more, with the columns of docs."""
    return scored(docs, learn_from(docs, labels)).where(F.col("_tm_score") >= least).select(*docs.columns)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    out = scored(docs.select("doc_id", "text", "lang", "source"), learn_from(docs, labels))
    return out.select("doc_id", F.col("_tm_score").alias("score"), (F.col("_tm_score") >= KEEP).alias("kept"))
