"""Near duplicates by order MinHash, verified by banded alignment.

A sketch of a text keeps, under each of several hash functions, its ``ELL`` smallest occurrence-labelled runs of five words in the
order in which they stand in the text; each is a band. Texts that share a band are candidates, and linked if an alignment of their
words has an edit similarity (1 - edits / words of the longer text) of 0.8 or more.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import count, groupby

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import forget, map_rows, stored, summed, table, utf8
from tidemark.llm.hashing import labelled, mix, run_hashes, word_hashes

SHINGLE, ELL, BANDS, LEAST = 5, 2, 12, 0.8
#: Rounds in which buckets are held against leaders, and cells of a text's words in ``spread``.
ROUNDS, SPREAD = 2, 2048
#: Rows of a block, two of which are paired at once, and members of a bucket up to which it is paired as it is, not word by word.
BLOCK, WIDE = 256, 4096
#: Cells in which words are counted, and pieces in which tasks send them.
CELLS, PIECES = 1 << 20, 64
_U = np.uint64
_ODD = mix(np.arange(1, BANDS + 1, dtype=_U) * _U(0x9E3779B97F4A7C15)) | _U(1)
_ADD = mix(_ODD)
_COMBINE = _U(0xD6E8FEB86659FD93)


def sketch(runs: np.ndarray, bands: int, ell: int = ELL) -> np.ndarray:
    """For each of ``bands`` hash functions the ``ell`` smallest of the runs, in the order in which they stand, as one number."""
    ell = min(ell, len(runs))
    if not ell:
        return np.zeros(0, np.int64)
    v = runs[None, :] * _ODD[:bands, None] + _ADD[:bands, None]
    v ^= v >> _U(32)
    at = np.sort(np.argpartition(v, ell - 1, axis=1)[:, :ell], axis=1)
    h = np.zeros(bands, _U)
    for j in range(ell):
        h = h * _COMBINE + runs[at[:, j]]
    return (h ^ (h >> _U(29))).view(np.int64)


def bands(words: np.ndarray) -> list[int]:
    """The BANDS sketches of a text; none if it has no words."""
    return sketch(shingles(words), BANDS).tolist()


def shingles(words: np.ndarray) -> np.ndarray:
    return labelled(run_hashes(words, SHINGLE))


def rarest(words: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Those of a text's labelled words, the ones in the emptiest cells first, of which any text that is linked to it has one among its own."""
    words = labelled(words)
    order = np.lexsort((words, counts[(words % _U(CELLS)).astype(np.int64)]))
    return words[order[: len(words) - math.ceil(LEAST * len(words) - 1e-9) + 1]]


def _agree(a: np.ndarray, b: np.ndarray) -> int:
    """Length of the common start."""
    n, at, step = min(len(a), len(b)), 0, 32
    while at < n:
        differ = a[at : at + step] != b[at : at + step] if at + step <= n else a[at:n] != b[at:n]
        if differ.any():
            return at + int(np.argmax(differ))
        at += step
        step *= 4
    return n


def edit_distance(a: np.ndarray, b: np.ndarray, most: int) -> int:
    """Of two sequences, or most + 1 if it is larger: the alignment stays within a band of ``most`` diagonals either way.

    Of each diagonal only the furthest place that d edits can reach is kept, all diagonals of a step at once, and those that ``most``
    edits can no longer bring to the end are left out.
    """
    k = _agree(a, b)
    a, b = a[k:], b[k:]
    k = _agree(a[::-1], b[::-1])
    a, b = a[: len(a) - k], b[: len(b) - k]
    n, m = len(a), len(b)
    goal = m - n
    if abs(goal) > most:
        return most + 1
    if not n or not m:
        return max(n, m)
    zero = most + 2
    reach = np.full(2 * most + 5, -2)
    reach[zero] = 0  # the common start is gone
    for d in range(most + 1):
        if reach[goal + zero] >= n:
            return d
        spare = most - d - 1
        lo, hi = max(-d - 1, goal - spare), min(d + 1, goal + spare)
        if lo > hi:
            break
        diagonal = np.arange(lo, hi + 1)
        at = diagonal + zero
        i = np.minimum(np.minimum(np.maximum(np.maximum(reach[at], reach[at + 1]) + 1, reach[at - 1]), n), m - diagonal)
        j = i + diagonal
        fine = (i >= 0) & (j >= 0)
        inner = np.flatnonzero(fine & (i < n) & (j < m))
        for x in inner[a[i[inner]] == b[j[inner]]].tolist():
            i[x] += _agree(a[i[x] :], b[j[x] :])
        reach[at] = np.where(fine, i, -2)
    return most + 1


def linked(a: np.ndarray, b: np.ndarray, least: float = LEAST) -> bool:
    """Whether two texts, given by their words' hashes, are near duplicates: their edit similarity is ``least`` or more.

    That many words of the longer text must be in the other one as well, which is looked at before they are aligned.
    """
    longest = max(len(a), len(b))
    most = int((1 - least) * longest + 1e-9)
    if longest - min(len(a), len(b)) > most or longest - len(np.intersect1d(labelled(a), labelled(b), assume_unique=True)) > most:
        return False
    return edit_distance(a, b, most) <= most


def text_key(text: str) -> Column:
    return F.unhex(F.md5(utf8(text)))


def sketches(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """(doc_id, node, bands): node stands for the text, so that exact copies are one."""

    def rows(docs: Iterator[tuple]) -> Iterator[tuple]:
        last: tuple = (None, [])
        for key, node, raw in docs:
            if node != last[0]:
                last = node, bands(word_hashes(raw))
            yield key, node, last[1]

    inputs = docs.select(F.col(doc_id).alias("doc_id"), text_key(text).alias("node"), utf8(text).alias("raw"))
    return map_rows(inputs, rows, f"doc_id {docs.schema[doc_id].dataType.simpleString()}, node binary, bands array<long>")


def components(links: DataFrame) -> DataFrame:
    """(node, root) for the nodes of links (a, b): the smallest node that each is connected to.

    Labels that changed spread along links until none does; from the third turn on they also jump to their label's label, so that long
    chains take few turns and stars need no more than they must.
    """
    both = links.select("a", "b").unionAll(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    labels = held = stored(both.groupBy(F.col("a").alias("node")).agg(F.least(F.col("a"), F.min("b")).alias("root")))
    changed = labels
    for turn in count():
        near = both.join(changed.withColumnsRenamed({"node": "b"}), "b").groupBy(F.col("a").alias("node")).agg(F.min("root").alias("near"))
        moved = labels.join(near, "node", "left").select("node", F.least("root", F.coalesce("near", "root")).alias("root"), F.col("root").alias("old"))
        if turn > 1:
            jump = labels.select(F.col("node").alias("root"), F.col("root").alias("next"))
            moved = moved.join(jump, "root", "left").select("node", F.least("root", F.coalesce("next", "root")).alias("root"), "old")
        moved = stored(moved)
        labels, changed = moved.select("node", "root"), moved.where("root <> old").select("node", "root")
        forget(held)
        held = moved
        if changed.isEmpty():
            return labels


def contracted(links: DataFrame, roots: DataFrame | None) -> DataFrame:
    """Roots after further links: those are between groups, which are few beside their members."""
    if roots is None:
        return stored(components(links))
    for side in ("a", "b"):
        links = links.join(roots.select(F.col("node").alias(side), F.col("root").alias("r")), side, "left").withColumn(side, F.coalesce("r", side)).drop("r")
    new = components(links)
    old = roots.join(new.select(F.col("node").alias("root"), F.col("root").alias("r")), "root", "left").select("node", F.coalesce("r", "root").alias("root"))
    return stored(old.unionByName(new.join(roots.select("node"), "node", "left_anti")))


def verified(pairs: DataFrame, words: DataFrame) -> DataFrame:
    """Those of the pairs (a, b) that are near duplicates; words has (node, words) for all of them."""

    def rows(pairs: Iterator[tuple]) -> Iterator[tuple]:
        for a, b, x, y in pairs:
            if linked(*(np.frombuffer(t, np.uint32).astype(_U) for t in (x, y))):
                yield a, b

    left, right = words.select(F.col("node").alias("a"), F.col("words").alias("x")), words.select(F.col("node").alias("b"), F.col("words").alias("y"))
    return map_rows(pairs.join(left, "a").join(right, "b").select("a", "b", "x", "y"), rows, "a binary, b binary")


def counted(words: DataFrame) -> np.ndarray:
    """How many labelled words fall into each of CELLS cells; a task sends its counts in few pieces."""

    def rows(texts: Iterator[tuple]) -> Iterator[tuple]:
        cells = np.zeros(CELLS)
        for (raw,) in texts:
            np.add.at(cells, (labelled(np.frombuffer(raw, np.uint32).astype(_U)) % _U(CELLS)).astype(np.int64), 1)
        for k, part in enumerate(np.split(cells, PIECES)):
            if part.any():
                yield k, 0, part.tobytes()

    got = summed(map_rows(words.select("words"), rows, "k int, n long, blob binary", chunk=4))
    return np.concatenate([got.get(k, np.zeros(CELLS // PIECES)) for k in range(PIECES)])


def spread(words: np.ndarray) -> np.ndarray:
    """How many words fall into each of SPREAD cells, up to 127. Texts that are linked differ by few: each edit moves two words at most."""
    return np.minimum(np.bincount((words >> _U(7)).astype(np.int64) % SPREAD, minlength=SPREAD), 127).astype(np.int8)


def met(rows: Iterator[tuple]) -> Iterator[tuple]:
    """Pairs (a, b) that may be linked, from rows (run, i, j, block, bucket, node, root, rest, n, spread, buckets) in order of (run, i, j).

    Members of block i are held against those of block j. Of the buckets that a pair shares only the smallest one yields it.
    """
    for (_, i, j), group in groupby(rows, key=lambda r: r[:3]):
        block, bucket, node, root, rest, n, cells, buckets = zip(*(r[3:] for r in group), strict=True)
        block, bucket, rest, n = np.array(block), np.array(bucket), np.array(rest), np.array(n)
        root = np.unique(np.array(root, object), return_inverse=True)[1]
        cells = np.frombuffer(b"".join(cells), np.int8).reshape(-1, SPREAD)
        if i == j:
            a, b = np.triu_indices(len(n), 1)
        else:
            x, y = np.flatnonzero(block == i), np.flatnonzero(block == j)
            a, b = np.repeat(x, len(y)), np.tile(y, len(x))
        longest = np.maximum(n[a], n[b])
        may = (root[a] != root[b]) & (bucket[a] == bucket[b]) & (np.minimum(rest[a], rest[b]) >= LEAST * longest - 1e-9)
        a, b, longest = a[may], b[may], longest[may]
        for at in range(0, len(a), 2048):
            p, q = a[at : at + 2048], b[at : at + 2048]
            apart = np.abs(cells[p] - cells[q]).sum(1, dtype=np.int32)
            near = apart <= n[p] + n[q] - 2 * LEAST * longest[at : at + 2048] + 1e-9
            for k, m in zip(p[near].tolist(), q[near].tolist(), strict=True):
                if min(set(buckets[k]).intersection(buckets[m])) == bucket[k]:
                    yield min(node[k], node[m]), max(node[k], node[m])


def alike(members: DataFrame, words: DataFrame, roots: DataFrame, wide: int = WIDE) -> DataFrame:
    """Pairs (a, b) of members (bucket, node) that share a bucket and have different roots, among them all that are linked.

    A bucket of up to ``wide`` members is one group. In a larger one only those meet that share a rare word: a link leaves LEAST of the
    longer text's words in common, so in any one order of all words two such texts share one of their first fifths (``rarest``), and
    from the first that they share on each has enough left; in the order of rarity what is common to many texts comes last, and unlike
    texts hardly meet. Groups are dealt out as pairs of blocks, and texts that meet are told apart by their words' ``spread``, which
    differs by n1 + n2 - 2 * LEAST * longest at most in linked ones; no pair that it tells apart becomes a row.
    """
    marked = members.join(members.groupBy("bucket").agg((F.count("*") > wide).alias("large")), "bucket")
    own = marked.groupBy("node").agg(F.collect_set("bucket").alias("buckets"), F.collect_set(F.expr("if(large, bucket, null)")).alias("large"))
    own = stored(own)
    counts = words.sparkSession.sparkContext.broadcast(None if own.where("size(large) > 0").isEmpty() else counted(words))

    def rows(texts: Iterator[tuple]) -> Iterator[tuple]:
        for node, raw, buckets, large, root in texts:
            text = np.frombuffer(raw, np.uint32).astype(_U)
            rare = rarest(text, counts.value).tolist() if large else []
            for bucket in buckets:
                if bucket not in large:
                    yield bucket, bucket, node, root, len(text), len(text)
                    continue
                for i, word in enumerate(rare):
                    yield mixed(word, bucket), bucket, node, root, len(text) - i, len(text)

    def spreads(texts: Iterator[tuple]) -> Iterator[tuple]:
        for node, raw, buckets in texts:
            yield node, spread(np.frombuffer(raw, np.uint32).astype(_U)).tobytes(), buckets

    inputs = own.join(words, "node").join(roots, "node", "left").select("node", "words", "buckets", "large", F.coalesce("root", "node").alias("root"))
    first = stored(map_rows(inputs, rows, "run long, bucket long, node binary, root binary, rest int, n int", chunk=20_000))
    groups = first.groupBy("run").agg(F.count("*").alias("size"), F.min("root").alias("lo"), F.max("root").alias("hi")).where("lo <> hi")
    first = first.join(groups.select("run", F.ceil(F.col("size") / BLOCK).cast("int").alias("blocks")), "run")
    marks = map_rows(own.join(words, "node").select("node", "words", "buckets"), spreads, "node binary, spread binary, buckets array<long>")
    dealt = first.join(marks, "node").withColumn("block", F.pmod(F.xxhash64("node"), "blocks").cast("int"))
    dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    dealt = dealt.select("run", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "block", "bucket", "node", "root", "rest", "n", "spread", "buckets")
    dealt = dealt.repartition("run", "i", "j").sortWithinPartitions("run", "i", "j")
    return map_rows(dealt, met, "a binary, b binary").distinct()


def mixed(word: int, bucket: int) -> int:
    """One key for a word within a bucket; others that share it cost time only."""
    x = (word ^ bucket * 0x9E3779B97F4A7C15) & 0xFFFFFFFFFFFFFFFF
    x = (x ^ x >> 29) * 0xBF58476D1CE4E5B9 & 0xFFFFFFFFFFFFFFFF
    return (x ^ x >> 32) - (1 << 63)


def connected(sketched: DataFrame, docs: DataFrame, text: str) -> DataFrame:
    """(node, root) of texts that near duplicates connect to others; a node without links may be missing.

    The members of a bucket (a band's value) are first held against its two leaders, those whose buckets are largest: a base text is
    in the largest ones, so its copies meet it. Where some are not connected, two others lead. All of a bucket that then still has
    members of different groups meet (``alike``), which loses no pair that may be linked: every pair that shares a bucket is decided,
    unless both are connected already.
    """
    spark = docs.sparkSession
    members = sketched.select("node", "bands").where(F.size("bands") > 0).dropDuplicates(["node"]).select("node", F.posexplode("bands").alias("band", "value")).select("node", F.xxhash64("band", "value").alias("bucket"))
    size = members.groupBy("bucket").agg(F.count("*").alias("size")).where("size > 1")
    shared = stored(members.join(size, "bucket"))
    if shared.isEmpty():
        forget(shared)
        return spark.createDataFrame([], "node binary, root binary")

    def rows(docs: Iterator[tuple]) -> Iterator[tuple]:
        for node, raw in docs:
            yield node, word_hashes(raw).astype(np.uint32).tobytes()

    texts = docs.select(text_key(text).alias("node"), utf8(text).alias("raw")).join(shared.select("node").distinct(), "node", "left_semi")
    words = stored(map_rows(texts, rows, "node binary, words binary", chunk=500).groupBy("node").agg(F.first("words").alias("words")))
    fame = shared.groupBy("node").agg(F.sum("size").alias("fame"))
    left, roots = stored(shared.drop("size").join(fame, "node")), None
    for _ in range(ROUNDS):
        now = left.withColumn("root", F.col("node")) if roots is None else left.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
        lead = now.groupBy("bucket").agg(F.max(F.struct("fame", "node", "root")).alias("lead"))
        both = now.join(lead, "bucket").where("node <> lead.node")
        second = both.groupBy("bucket").agg(F.max(F.struct("fame", "node", "root")).alias("second"))
        both = stored(both.join(second, "bucket").select("bucket", "node", "fame", "root", "lead", "second"))
        pairs = both.select("node", "root", F.explode(F.array("lead", "second")).alias("l")).where("node <> l.node and root <> l.root")
        found = stored(verified(pairs.select(F.least("node", "l.node").alias("a"), F.greatest("node", "l.node").alias("b")).distinct(), words))
        roots = contracted(found, roots)
        # leaders have met all of their bucket; one whose other members are connected is done
        after = both.where("node <> second.node").select("bucket", "node", "fame").join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
        several = after.groupBy("bucket").agg(F.min("root").alias("lo"), F.max("root").alias("hi")).where("lo <> hi").select("bucket")
        left = stored(after.drop("root").join(several, "bucket", "left_semi"))
        if left.isEmpty():
            return roots
    rest = stored(words.join(left.select("node").distinct(), "node", "left_semi"))
    return contracted(stored(verified(stored(alike(left.select("bucket", "node"), rest, roots)), rest)), roots)


def classes(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, node, root, class_id) of every row; root stands for the class: class_id is the smallest doc_id among the texts that near duplicates connect.

    Null and empty texts, and others without words, are linked to exact copies only (null counts as empty). Texts of five words or
    fewer have one run, all their words. Rows that repeat are in one class; null ids are passed over for class_id, which is null if
    a class has no other.
    """
    sketched = stored(sketches(docs, doc_id, text))
    roots = connected(sketched, docs, text)
    rooted = sketched.select("doc_id", "node").join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    named = rooted.groupBy("root").agg(F.min("doc_id").alias("class_id"))
    return rooted.join(named, "root").select("doc_id", "node", "root", "class_id")


def distinct(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """docs without near duplicates: of each class one row stays, of those with the smallest id one with the smallest text key.

    Classes are told apart by their root, not by their id, which others may share or lack.
    """
    kept = classes(docs, doc_id, text).where(F.col("doc_id").eqNullSafe(F.col("class_id"))).groupBy("root").agg(F.min("node").alias("_tm_keep"), F.first("class_id").alias("_tm_class"))
    own = docs.withColumn("_tm_key", text_key(text))
    out = own.join(kept, (F.col("_tm_key") == F.col("_tm_keep")) & F.col(doc_id).eqNullSafe(F.col("_tm_class")), "left_semi")
    return out.dropDuplicates([doc_id, "_tm_key"]).drop("_tm_key")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classes(table(spark, sf_dir, "documents")).select("doc_id", "class_id")
