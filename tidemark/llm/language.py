"""Language-model scoring: a two-level log-bilinear model, trained by noise-contrastive estimation.

The commonest words are classes with vectors of their own; every other word, seen or not, belongs to a class by its last two bytes.
Classes are ordered by how common they are and cut into clusters. From the words before, one log-bilinear network predicts the
cluster, and another one, over the same context vector, the class within the cluster; a word's share of a class that it does not have
for itself is its add-one estimate there, with one further word in each such class that stands for all unseen ones. All three are
normalised, so the product is a probability over the same words as the base's.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import repeat

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import fold, map_rows, stored, summed, table, utf8

#: Words with a class of their own at most (the end of a text is one more class), and classes for all others.
OWN, SHARED = 8_192, 512
#: Commonest words whose counts go to every worker; the counts of all others are joined.
KNOWN = 200_000
#: Classes in a cluster: of the COMMON commonest ones, and of the others.
COMMON, SMALL, LARGE = 1_024, 32, 128
WORDS_BACK, WIDTH, BATCH = 3, 16, 4096
#: Noise samples: clusters for a batch, classes for each cluster of a batch.
NOISE, INNER_NOISE = 24, 3
#: Tokens of a shard, about: each trains a copy of the first network, and what shards learned is averaged.
SHARD = 1 << 22
#: Blocks of classes in which shards are summed.
PARTS = 16


@dataclass
class Classes:
    """Classes, the commonest first, with their shares of training tokens; cluster k has those from edges[k] to edges[k + 1]."""

    share: np.ndarray
    edges: np.ndarray

    @staticmethod
    def of(share: np.ndarray) -> Classes:
        n = len(share)
        edges = np.unique(np.concatenate([np.arange(0, min(n, COMMON), SMALL), np.arange(min(n, COMMON), n, LARGE), [n]]))
        return Classes(share, edges)

    @property
    def start(self) -> int:
        """What stands before a text."""
        return len(self.share)

    @property
    def cluster(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.edges) - 1, dtype=np.int16), np.diff(self.edges))

    @property
    def clusters(self) -> np.ndarray:
        """Their shares."""
        return np.add.reduceat(self.share, self.edges[:-1])

    @property
    def within(self) -> np.ndarray:
        """The share of each class in its cluster."""
        return self.share / self.clusters[self.cluster]


#: Arrays of a network with a row for each class (inner has one more, for what stands before a text), and the others.
BY_CLASS, OTHERS = ("inner", "outer"), ("back", "top")


@dataclass
class Network:
    """With h = sum over j of back[j] * inner[word j back] and a 1 at its end: score(cluster) = h . top, score(class) = h . outer."""

    classes: Classes
    inner: np.ndarray
    outer: np.ndarray
    back: np.ndarray
    top: np.ndarray

    @staticmethod
    def fresh(classes: Classes, seed: int = 7) -> Network:
        """At first, scores are those of the shares alone, almost."""
        rng = np.random.default_rng(seed)
        f, n, k = np.float32, len(classes.share), len(classes.edges) - 1
        rows = lambda m: rng.normal(0, 0.1, (m, WIDTH))
        with_bias = lambda x, share: np.concatenate([x, np.log(share)[:, None]], 1).astype(f)
        return Network(classes, rows(n + 1).astype(f), with_bias(rows(n), classes.within), np.full((WORDS_BACK, WIDTH), 0.6, f), with_bias(rows(k), classes.clusters))

    def context(self, before: np.ndarray) -> np.ndarray:
        h = np.ones((len(before), WIDTH + 1), np.float32)
        v = self.inner[before[:, 0]]
        v *= self.back[0]
        for j in range(1, WORDS_BACK):
            x = self.inner[before[:, j]]
            x *= self.back[j]
            v += x
        h[:, :WIDTH] = v
        return h

    @staticmethod
    def _log_shares(h: np.ndarray, vectors: np.ndarray, own: np.ndarray) -> np.ndarray:
        """log softmax of h @ vectors at own."""
        s = h @ vectors
        value = s[np.arange(len(own)), own].astype(np.float64)
        top = max(0.0, float(s.max()) - 60)  # float32 holds exp(60)
        if top:
            s -= np.float32(top)
        np.exp(s, out=s)
        return value - top - np.log(s.sum(1, dtype=np.float32))

    def log10(self, before: np.ndarray, after: np.ndarray) -> np.ndarray:
        """Normalised log10 probabilities of the classes ``after``."""
        out, cluster, edges = np.empty(len(after)), self.classes.cluster, self.classes.edges
        order = np.argsort(cluster[after], kind="stable")
        key, own = cluster[after[order]], after[order]
        h = self.context(before[order])
        top = np.ascontiguousarray(self.top.T)
        for at in range(0, len(after), 2048):
            part = slice(at, at + 2048)
            out[part] = self._log_shares(h[part], top, key[part])
        ends = np.append(np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])), len(key)) if len(key) else [0]
        for a, b in zip(ends[:-1], ends[1:], strict=True):
            lo, hi = edges[key[a]], edges[key[a] + 1]
            vectors = np.ascontiguousarray(self.outer[lo:hi].T)
            for at in range(a, b, 2048):
                part = slice(at, min(b, at + 2048))
                out[part] += self._log_shares(h[part], vectors, own[part] - lo)
        back = np.empty(len(after))
        back[order] = out / np.log(10)
        return back


def histories(ids: np.ndarray, start: int) -> np.ndarray:
    """For each place of a text the WORDS_BACK classes before it, the nearest first; ``start`` before its first."""
    padded = np.concatenate([np.full(WORDS_BACK, start, np.int16), ids])
    return np.stack([padded[WORDS_BACK - 1 - j : len(padded) - 1 - j] for j in range(WORDS_BACK)], 1)


def _sums(keys: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(different keys, sums of their rows)."""
    order = np.argsort(keys, kind="stable")
    k = keys[order]
    starts = np.flatnonzero(np.concatenate([[True], k[1:] != k[:-1]]))
    return k[starts], np.add.reduceat(values[order], starts)


def _pull(score: np.ndarray) -> np.ndarray:
    """Probability that a sample is data rather than noise."""
    x = np.clip(score, -30, 30)
    np.exp(-x, out=x)
    x += 1
    return np.reciprocal(x, out=x)


class Trainer:
    """Noise-contrastive estimation with Adagrad; a batch shares its noise, so that scores are matrix products, and only rows that it meets move."""

    def __init__(self, net: Network, seed: int, rate: float = 0.1) -> None:
        self.net, self.rate = net, rate
        self.rng = np.random.default_rng(seed)
        c = net.classes
        self.cluster, self.edges = c.cluster, c.edges
        self.top_sum, self.sum = np.cumsum(c.clusters), np.cumsum(c.share)
        self.log_top, self.log_in = np.log(NOISE * c.clusters).astype(np.float32), np.log(INNER_NOISE * c.within).astype(np.float32)
        self.past = {k: np.full_like(getattr(net, k), 1.0) for k in (*BY_CLASS, *OTHERS)}
        self.seen = np.zeros(len(c.share) + 1)  # how often each class was met

    def _move(self, name: str, grad: np.ndarray, rows=slice(None)) -> None:
        past = self.past[name][rows] + grad * grad
        self.past[name][rows] = past
        getattr(self.net, name)[rows] -= self.rate * grad / np.sqrt(past)

    def step(self, before: np.ndarray, after: np.ndarray) -> None:
        net, edges = self.net, self.edges
        order = np.argsort(self.cluster[after], kind="stable")
        before, after = before[order], after[order]
        key = self.cluster[after]
        starts = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
        here = key[starts]
        h = net.context(before)
        # clusters
        noise = np.minimum(np.searchsorted(self.top_sum, self.rng.random(NOISE) * self.top_sum[-1]), len(self.top_sum) - 1)
        real, fake = net.top[key], net.top[noise]
        g1 = _pull(np.einsum("ij,ij->i", h, real) - self.log_top[key]) - 1
        n1 = _pull(h @ fake.T - self.log_top[noise])
        g_h = g1[:, None] * real
        g_h += n1 @ fake
        g_top = np.zeros_like(net.top)
        g_top[here] = np.add.reduceat(g1[:, None] * h, starts)
        np.add.at(g_top, noise, n1.T @ h)
        # classes in their clusters
        low, high = np.concatenate([[0], self.sum])[edges[here]], self.sum[edges[here + 1] - 1]
        drawn = np.searchsorted(self.sum, low[:, None] + self.rng.random((len(here), INNER_NOISE)) * (high - low)[:, None], "right")
        drawn = np.clip(drawn, edges[here][:, None], edges[here + 1][:, None] - 1).astype(np.int16)
        mine = np.repeat(np.arange(len(here)), np.diff(np.append(starts, len(key))))
        own = net.outer[after]
        g2 = _pull(np.einsum("ij,ij->i", h, own) - self.log_in[after]) - 1
        own *= g2[:, None]
        g_h += own
        keys, values = [after], [g2[:, None] * h]
        for j in range(INNER_NOISE):
            other = net.outer[drawn[:, j]][mine]
            n2 = _pull(np.einsum("ij,ij->i", h, other) - self.log_in[drawn[:, j]][mine])
            other *= n2[:, None]
            g_h += other
            keys.append(drawn[:, j])
            values.append(np.add.reduceat(n2[:, None] * h, starts))
        rows, g_outer = _sums(np.concatenate(keys), np.concatenate(values))
        # words before
        g_h = g_h[:, :WIDTH]
        met, g_inner = _sums(before.T.reshape(-1), np.concatenate([g_h * net.back[j] for j in range(WORDS_BACK)]))
        g_back = np.stack([np.einsum("ij,ij->j", g_h, net.inner[before[:, j]]) for j in range(WORDS_BACK)])
        self._move("top", g_top)
        self._move("outer", g_outer, rows)
        self._move("inner", g_inner, met)
        self._move("back", g_back)
        self.seen += np.bincount(after, minlength=len(self.seen))


@dataclass
class Lexicon:
    """The KNOWN commonest words with their places, classes and counts; the totals of training tokens; class sizes."""

    place: dict[bytes, int]
    of_place: np.ndarray  # class by place
    counts: np.ndarray  # by place
    own: int  # the first places have classes of their own
    shared: np.ndarray  # class of each ending
    end: int  # class of a text's end
    n: int
    v: int
    texts: int
    classes: Classes
    within: np.ndarray  # add-one denominators of the shared classes, 1 for the others
    step: int  # words of higher steps are known, of this one those with a smaller part
    part: int

    def ids(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """(places, -1 if not KNOWN; classes)"""
        get = self.place.get
        places = np.fromiter(map(get, words, repeat(-1)), np.int64, len(words))
        classes = self.of_place[places] if len(self.of_place) else np.zeros(len(words), np.int16)
        for i in np.flatnonzero(places < 0):
            classes[i] = self.shared[ending(words[i])]
        return places, classes

    def known(self) -> Column:
        return (_step() > self.step) | ((_step() == self.step) & (_part() < self.part))


def ending(word: bytes) -> int:
    return zlib.crc32(word[-2:]) % SHARED


def _step() -> Column:
    """64 steps for each power of 2 of a count."""
    return F.floor(64 * F.log2("c")).cast("int")


def _part() -> Column:
    return F.pmod(F.xxhash64("word"), F.lit(4096)).cast("int")


def word_counts(docs: DataFrame) -> DataFrame:
    """(word binary, c) over rows (raw binary), with A-Z in lower case; each task sums what it can before the shuffle."""

    def rows(docs: Iterator[tuple]) -> Iterator[tuple]:
        held: Counter = Counter()
        for (raw,) in docs:
            held.update(raw.lower().split())
            if len(held) > 400_000:
                yield from held.items()
                held.clear()
        yield from held.items()

    return map_rows(docs, rows, "word binary, c long", chunk=50_000).groupBy("word").agg(F.sum("c").alias("c"))


def lexicon(counted: DataFrame, texts: int) -> Lexicon:
    """To the driver go the commonest words, KNOWN of them at most, and sums for each ending.

    Which words are known is told by steps of their counts, and in the last step by parts of a hash, so that no word has to be sorted.
    """
    last, part, room = 0, 4096, KNOWN
    for r in sorted(counted.groupBy(_step().alias("step")).agg(F.count("*").alias("words")).collect(), reverse=True):
        if r["words"] > room:
            last, part = r["step"], 0
            for x in sorted(counted.where(_step() == last).groupBy(_part().alias("part")).agg(F.count("*").alias("words")).collect()):
                if x["words"] > room:
                    break
                room, part = room - x["words"], x["part"] + 1
            break
        room -= r["words"]
    words = Lexicon({}, np.zeros(0, np.int16), np.zeros(0, np.int64), 0, np.zeros(SHARED, np.int16), 0, 0, 0, texts, Classes.of(np.ones(1)), np.ones(1), last, part)
    top = counted.where(words.known()).toArrow()
    count, word = top.column("c").to_numpy(), top.column("word").to_pylist()
    order = sorted(range(len(word)), key=lambda i: (-count[i], word[i]))
    ordered, words.counts = [word[i] for i in order], count[order].astype(np.int64)
    words.place = {w: i for i, w in enumerate(ordered)}
    words.own = min(OWN, len(ordered))
    by = {r["k"]: (r["n"], r["v"]) for r in counted.groupBy((F.crc32(F.expr("substring(word, -2, 2)")) % SHARED).cast("int").alias("k")).agg(F.sum("c").alias("n"), F.count("*").alias("v")).collect()}
    n, v = np.zeros(SHARED), np.zeros(SHARED)
    for k, (a, b) in by.items():
        n[k], v[k] = a, b
    words.n, words.v = int(n.sum()) + texts, int(v.sum()) + (texts > 0)
    for w, c in zip(ordered[: words.own], words.counts, strict=False):
        n[ending(w)] -= c
        v[ending(w)] -= 1
    size = np.concatenate([words.counts[: words.own], [texts], n]) + 0.5
    by_size = np.argsort(-size, kind="stable")
    rank = np.empty(len(size), np.int16)
    rank[by_size] = np.arange(len(size))
    words.classes = Classes.of(size[by_size] / size.sum())
    words.within = np.concatenate([np.ones(words.own + 1), n + v + 1])[by_size]
    words.end, words.shared = int(rank[words.own]), rank[words.own + 1 :]
    words.of_place = np.array([rank[i] if i < words.own else words.shared[ending(w)] for i, w in enumerate(ordered)], np.int16)
    return words


def encoded(docs: DataFrame, words: Lexicon, doc_id: str, text: str, learn: Column) -> DataFrame:
    """(doc_id, row, learn, n_tokens, n_known, grown, apart, ids, rest) of every row, stored.

    ids are the classes as 16-bit integers, the end's last; grown has the base's numerators of the KNOWN words, apart the words' shares
    of their classes, as sums of log10; rest has the words that aren't KNOWN.
    """
    sent = docs.sparkSession.sparkContext.broadcast(words)  # KNOWN words at most

    def rows(docs: Iterator[tuple]) -> Iterator[tuple]:
        words = sent.value
        grown, within = np.log10(words.counts + 1.0), np.log10(words.within)
        end = np.int16(words.end)
        for key, learn, raw in docs:
            text = raw.lower().split()
            places, classes = words.ids(text)
            ids = np.append(classes, end).astype(np.int16)
            known = places[places >= 0]
            apart = float(grown[known[known >= words.own]].sum()) - float(within[ids].sum())
            yield key, learn, len(ids), len(known) + (words.texts > 0), float(grown[known].sum()), apart, ids.tobytes(), [text[i] for i in np.flatnonzero(places < 0)]

    kind = docs.schema[doc_id].dataType.simpleString()
    inputs = docs.select(F.col(doc_id).alias("doc_id"), learn.alias("learn"), utf8(text).alias("raw"))
    out = map_rows(inputs, rows, f"doc_id {kind}, learn boolean, n_tokens long, n_known long, grown double, apart double, ids binary, rest array<binary>", chunk=500)
    return stored(out.withColumn("row", F.monotonically_increasing_id()))


def train(texts: DataFrame, words: Lexicon, tokens: int) -> Network:
    """The network from all rows (ids binary) of classes, with ``tokens`` in all.

    Texts are dealt to shards of about SHARD tokens by a hash of their classes, and go in its order, so that the model does not depend
    on how the table is cut into partitions. Each shard trains a copy of the same first network; the model is their mean, for each
    class weighted by how often the shard met it.
    """
    sent = texts.sparkSession.sparkContext.broadcast(words.classes)
    shards = max(1, -(-tokens // SHARD))

    def rows(texts: Iterator[tuple]) -> Iterator[tuple]:
        classes = sent.value
        at, trainer, held, waiting = None, None, [], 0

        def learn() -> None:
            nonlocal held, waiting
            before, after = (np.concatenate(x) for x in zip(*held, strict=True))
            order = trainer.rng.permutation(len(after))
            for a in range(0, len(order), BATCH):
                trainer.step(before[order[a : a + BATCH]], after[order[a : a + BATCH]])
            held, waiting = [], 0

        def done() -> Iterator[tuple]:
            if held:
                learn()
            net, seen = trainer.net, trainer.seen[:-1] + 1e-3
            tokens = float(trainer.seen.sum())
            for k, part in enumerate(np.array_split(np.arange(len(seen)), PARTS)):
                w = seen[part][:, None]
                yield k, at, np.concatenate([w, w * net.inner[part], w * net.outer[part]], 1).astype(np.float64).tobytes()
            others = np.concatenate([net.inner[-1], *(getattr(net, x).reshape(-1) for x in OTHERS)])
            yield PARTS, at, (tokens * np.append(others, 1.0)).astype(np.float64).tobytes()

        for shard, raw in texts:
            if shard != at:
                if at is not None:
                    yield from done()
                at, trainer, held, waiting = shard, Trainer(Network.fresh(classes), shard + 1), [], 0
            ids = np.frombuffer(raw, np.int16)
            held.append((histories(ids, classes.start), ids))
            waiting += len(ids)
            if waiting >= 4 * BATCH:
                learn()
        if at is not None:
            yield from done()

    order = F.xxhash64("ids")
    dealt = texts.select(F.pmod(order, F.lit(shards)).cast("long").alias("shard"), "ids").repartition(shards, "shard").sortWithinPartitions("shard", F.xxhash64("ids"), "ids")
    got = summed(map_rows(dealt, rows, "k int, n long, blob binary", chunk=4))
    net = Network.fresh(words.classes)
    if not got:
        return net
    for k, part in enumerate(np.array_split(np.arange(len(words.classes.share)), PARTS)):
        if len(part):
            x = got[k].reshape(len(part), -1)
            x = (x[:, 1:] / x[:, :1]).astype(np.float32)
            net.inner[part], net.outer[part] = x[:, :WIDTH], x[:, WIDTH:]
    x, at = (got[PARTS][:-1] / got[PARTS][-1]).astype(np.float32), WIDTH
    net.inner[-1] = x[:WIDTH]
    for name in OTHERS:
        own = getattr(net, name)
        own[...] = x[at : at + own.size].reshape(own.shape)
        at += own.size
    return net


def scored(texts: DataFrame, counted: DataFrame, words: Lexicon, net: Network) -> DataFrame:
    """(doc_id, learn, n_tokens, n_known, base_score, score) of every row of ``encoded``: log10 probabilities of the whole text, its end included.

    Null and empty texts are scored for their end alone; rows that repeat are scored one by one. Words beyond the KNOWN ones are
    joined with their counts, row by row of the tokens that need it, and summed back.
    """
    sent = texts.sparkSession.sparkContext.broadcast(net)  # OWN + SHARED + 1 vectors at most

    def rows(texts: Iterator[tuple]) -> Iterator[tuple]:
        net = sent.value
        group: list[tuple] = []

        def flush() -> Iterator[tuple]:
            if not group:
                return
            ids = [g[-1] for g in group]
            p = net.log10(np.concatenate([histories(i, net.classes.start) for i in ids]), np.concatenate(ids))
            for g, total in zip(group, np.add.reduceat(p, np.concatenate([[0], np.cumsum([len(i) for i in ids])[:-1]])), strict=True):
                yield *g[:-2], float(total) + g[-2]
            group.clear()

        waiting = 0
        for *rest, raw in texts:
            group.append((*rest, np.frombuffer(raw, np.int16)))
            waiting += len(group[-1][-1])
            if waiting >= 1 << 16:
                yield from flush()
                waiting = 0
        yield from flush()

    kind = texts.schema["doc_id"].dataType.simpleString()
    first = map_rows(texts.select("doc_id", "row", "learn", "n_tokens", "n_known", "grown", "apart", "ids"), rows, f"doc_id {kind}, row long, learn boolean, n_tokens long, n_known long, grown double, score double", chunk=5000)
    rest = texts.select("row", F.explode("rest").alias("word")).groupBy("word", "row").agg(F.count("*").alias("times"))
    joined = rest.join(counted.where(~words.known()), "word")
    sums = joined.groupBy("row").agg(F.sum("times").alias("more"), F.sum(F.col("times") * F.log10(F.col("c") + 1.0)).alias("more_grown"))
    out = first.join(sums, "row", "left")
    more = F.coalesce(F.col("more_grown"), F.lit(0.0))
    ends = float(np.log10(words.texts + 1.0))
    base = F.col("grown") + more + ends - F.col("n_tokens") * float(np.log10(words.n + words.v + 1))
    return out.select("doc_id", "learn", "n_tokens", (F.col("n_known") + F.coalesce("more", F.lit(0))).cast("long").alias("n_known"), base.alias("base_score"), (F.col("score") + more).alias("score"))


def scores(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", learn: Column | None = None) -> tuple[DataFrame, Lexicon, Network]:
    """(``scored`` of all docs, lexicon, network), learned from the rows where ``learn`` holds (all, if it isn't given)."""
    learn = F.lit(True) if learn is None else F.coalesce(learn, F.lit(False))
    own = docs.where(learn).select(utf8(text).alias("raw"))
    counted = stored(word_counts(own))
    words = lexicon(counted, own.count())
    texts = encoded(docs, words, doc_id, text, learn)
    net = train(texts.where("learn").select("ids"), words, words.n)
    return scored(texts, counted, words, net), words, net


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    out, words, _ = scores(table(spark, sf_dir, "documents"), learn=fold("doc_id", 7) != 2)
    return out.select("doc_id", (~F.col("learn")).alias("held_out"), "n_tokens", "n_known", F.lit(words.n).cast("long").alias("train_tokens"), "base_score", "score")
