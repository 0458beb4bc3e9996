"""Each operator against a brute-force version on small tables, and on awkward ones: nulls, empty and long texts, repeated rows, no rows, clashing columns."""

import hashlib
import math
import random
import tracemalloc
import zlib
from collections import Counter

import numpy as np
import pytest

from tidemark.llm import bpe, common, cotraining, hashing, language, mixing, nearest, neardup, pages, repeats, rules, stats, suffixes, toxicity

DOCS = "doc_id long, text string, lang string, source string, n_chars long, _size int, score double, key string"
LABELS = "doc_id long, quality int, toxic int"


def words(r, n):
    return " ".join("".join(r.choice("abcdeé") for _ in range(r.randint(1, 6))) for _ in range(n))


@pytest.fixture(scope="module")
def awkward(spark, tmp_path_factory):
    """A folder of tables with every oddity the operators must stand."""
    r = random.Random(9)
    top = tmp_path_factory.mktemp("awkward")
    body = words(r, 120)
    texts = [body, body, None, "", " \n\t ", "one", words(r, 9000), body.replace("a", "b", 2), "é" * 3000, "x" * 250, "x" * 250, "*** ### $$$ " * 60, "\n".join(["same line here"] * 40), "<|endoftext|> it's", "日本語 テキスト"] + [words(r, r.randint(1, 90)) for _ in range(60)]
    rows = [(i if i != 4 else None, t, ["en", None][i % 7 == 0], [None, "a", "b", "ü"][i % 4], None if i % 5 == 0 else len(t or ""), 1, 0.5, "k") for i, t in enumerate(texts)]
    rows += [rows[0], rows[0], rows[9]]
    labels = [(i, int(i % 3 > 0), int(i % 4 == 0)) for i in range(0, 70, 2)] + [(None, 1, 1), (5, None, None), (3, 1, None)]
    spark.createDataFrame(rows, DOCS).coalesce(1).write.parquet(f"{top}/documents.parquet")
    spark.createDataFrame(labels, LABELS).coalesce(1).write.parquet(f"{top}/labels.parquet")
    rng = np.random.default_rng(1)
    vectors = [(i, rng.normal(size=16).tolist(), 1) for i in range(400)] + [(500, None, 1), (600, [0.0] * 16, 1), (700, [float("nan")] * 16, 1), (800, [1.0, None], 1), (None, [1.0] * 16, 1), (900, [1.0] * 3, 1)]
    vectors += [(1000 + i, vectors[0][1], 1) for i in range(30)]
    spark.createDataFrame(vectors, "vec_id long, embedding array<double>, label int").coalesce(1).write.parquet(f"{top}/embeddings.parquet")
    html = ["<body><nav><a>x</a></nav><article><p>a &amp; b</p><p>c<br>d</p></article><footer>f</footer>", None, "", "no tags at all", "<script>only", "<p>" * 3000 + "deep", "<article><p>q</article>" * 2]
    spark.createDataFrame([(i if i != 3 else None, f"u{i}", h, "t") for i, h in enumerate(html)], "page_id long, url string, html string, text string").coalesce(1).write.parquet(f"{top}/pages.parquet")
    return str(top), rows


@pytest.fixture(scope="module")
def nothing(spark, tmp_path_factory):
    top = tmp_path_factory.mktemp("nothing")
    for name, schema in (("documents", DOCS), ("labels", LABELS), ("embeddings", "vec_id long, embedding array<float>, label int"), ("pages", "page_id long, url string, html string")):
        spark.createDataFrame([], schema).write.parquet(f"{top}/{name}.parquet")
    return str(top)


@pytest.mark.parametrize("name", ["op1_rules", "op2_language", "op3_repeats", "op4_neardup", "op5_toxicity", "op6_cotraining", "op7_nearest", "op8_mixing", "op9_bpe", "op10_pages", "pipeline"])
def test_empty_tables_give_empty_results(spark, nothing, name):
    import __spark_entry__

    assert __spark_entry__.queries()[name](spark, nothing).collect() == []


def split(text):
    return (text or "").encode().split()


def test_rules(spark, awkward):
    top, rows = awkward
    got = rules.query(spark, top).collect()
    assert len(got) == len(rows)
    by = {}
    for r in got:
        by.setdefault(r.doc_id, r)
    for i, text, *_ in rows:
        w = split(text)
        windows = Counter(zip(w, w[1:], w[2:]))
        hit = {j for k in range(len(w) - 2) if windows[tuple(w[k : k + 3])] > 1 for j in (k, k + 1, k + 2)}
        lines = [x for x in (text or "").split("\n") if x.encode().split()]
        want = (len(w), sum(len(x.decode()) for x in w), sum(c in "#*$%&|<>" for c in text or ""), len(lines) - len(set(lines)), len(hit))
        r = by[i]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == want
        assert r.base_failed == (want[0] < 50 or 100 * want[4] > 50 * want[0]) and not (r.base_failed and r.kept)


def test_rules_find_a_planted_conjunction():
    rng = np.random.default_rng(0)
    x = rng.random((3000, len(stats.FEATURES)))
    bad = (x[:, 2] > 0.7) & (x[:, 5] < 0.4)
    found = rules.learn(x, bad)
    said = np.zeros(len(x), bool)
    for rule in found:
        said |= rules.covers(rule, x)
    assert (said == bad).mean() > 0.98


def test_language_base_and_normalisation(spark, awkward):
    top, rows = awkward
    got = language.query(spark, top).collect()
    counts, sums = Counter(), {}
    for i, text, *_ in rows:
        w = [*(text or "").encode().lower().split(), None]
        sums.setdefault(i, w)
        if zlib.crc32(("" if i is None else str(i)).encode()) % 7 != 2:
            counts.update(w)
    n, v = sum(counts.values()), len(counts)
    assert len(got) == len(rows)
    for r in got:
        w = sums[r.doc_id]
        assert r.train_tokens == n and r.n_tokens == len(w) and r.n_known == sum(counts[x] > 0 for x in w)
        assert math.isclose(r.base_score, sum(math.log10((counts[x] + 1) / (n + v + 1)) for x in w), rel_tol=1e-9, abs_tol=1e-9)
        assert r.score < 0
    assert language.Classes.of(np.full(3000, 1 / 3000)).edges[-1] == 3000


def test_language_model_is_normalised_over_words_and_doesnt_depend_on_partitions(spark, sf_dir):
    docs = common.table(spark, sf_dir, "documents").select("doc_id", "text")
    first, words, net = language.scores(docs.repartition(1))
    again, _, other = language.scores(docs.repartition(5))
    for name in (*language.BY_CLASS, *language.OTHERS):
        assert np.allclose(getattr(net, name), getattr(other, name), rtol=1e-5, atol=1e-6)
    a, b = ({r.doc_id: (r.n_tokens, r.n_known, r.score) for r in x.collect()} for x in (first, again))
    assert set(a) == set(b) and all(a[k][:2] == b[k][:2] and math.isclose(a[k][2], b[k][2], rel_tol=1e-6) for k in a)
    n = len(words.classes.share)
    rng = np.random.default_rng(1)
    for _ in range(3):
        before = np.repeat(rng.integers(0, n + 1, (1, language.WORDS_BACK)).astype(np.int16), n, 0)
        of_class = 10 ** net.log10(before, np.arange(n, dtype=np.int16))
        total = np.zeros(n)  # of each class's words: those with a class of their own, the end, the others and one unseen word
        total[words.end] = 1
        for place, (k, c) in enumerate(zip(words.of_place, words.counts)):
            total[k] += 1 if place < words.own else (c + 1) / words.within[k]
        for k in words.shared:
            total[k] += 1 / words.within[k]
        assert math.isclose((of_class * total).sum(), 1, rel_tol=1e-4) and np.allclose(total, 1)


def test_language_model_beats_the_base_on_held_out_texts(spark):
    got = [r for r in language.query(spark, "/root/testdata/sf0.01").collect() if r.held_out]
    assert sum(r.score - r.base_score for r in got) / sum(r.n_tokens for r in got) > 0.1


def test_suffix_order_and_common_prefixes():
    r = random.Random(5)
    for _ in range(150):
        x = np.array([r.randint(1, r.choice([1, 2, 4])) for _ in range(r.randint(0, 50))] + [0])
        depth = r.choice([3, 8, 100])
        got = [(int(p), int(c)) for ps, cs in suffixes.suffixes(x, depth, held=r.choice([0, 4])) for p, c in zip(ps, cs, strict=True)]
        assert sorted(p for p, _ in got) == list(range(len(x)))
        for (p, _), (q, c) in zip(got, got[1:]):
            a, b = tuple(x[p:]), tuple(x[q:])
            same = next((i for i, (s, t) in enumerate(zip(a, b)) if s != t), min(len(a), len(b)))
            assert c == min(same, depth) and a[:depth] >= b[:depth]


def repeats_by_force(rows):
    docs = sorted({(-(2**63) if i is None else i, (t or "").encode()) for i, t, *_ in rows})
    first, out = {}, {}
    for i, b in docs:
        for p in range(len(b) - 99):
            first.setdefault(b[p : p + 100], (i, b, p))
    for i, b in docs:
        gone = np.zeros(len(b), bool)
        for p in range(len(b) - 99):
            if first[b[p : p + 100]] != (i, b, p):
                gone[p : p + 100] = True
        edge = np.diff(np.concatenate([[0], gone.astype(int), [0]]))
        out[i] = len(b), int(gone.sum()), int((edge == 1).sum()), hashlib.sha256(bytes(c for c, g in zip(b, gone) if not g)).hexdigest()
    return out


def test_repeats(spark, awkward):
    top, rows = awkward
    want = repeats_by_force(rows)
    got = repeats.query(spark, top).collect()
    assert len(got) == len(rows)
    for r in got:
        assert (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) == want[-(2**63) if r.doc_id is None else r.doc_id]
    docs = common.table(spark, top, "documents")
    out = repeats.deduplicated(docs)
    assert out.columns == docs.columns and out.count() == docs.count()


def test_each_string_is_in_the_context_of_an_anchor():
    r = random.Random(11)
    for _ in range(40):
        texts = [bytes(r.choice(b"ab") for _ in range(r.randint(0, 260))) if r.random() < 0.5 else b"xy" * r.randint(0, 130) for _ in range(4)]
        data, ends = np.frombuffer(b"".join(texts), np.uint8), np.cumsum([len(t) for t in texts])
        if len(data) < 100:
            continue
        at, _, most, nearest = repeats.anchors(data, ends)
        spans = [repeats.extent(int(c)) for c in repeats.coded(at, most, nearest)]
        begin = 0
        for t in texts:
            for x in range(begin, begin + len(t) - 99):
                assert any(lo <= x and x + 100 <= hi for lo, hi, _ in spans)
            begin += len(t)
            assert all(lo >= begin or hi <= begin for lo, hi, _ in spans)


def test_repeats_of_periodic_and_spliced_texts(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(repeats, "SORTED", 4000)
    r = random.Random(2)
    base = [bytes(r.choice(b"ab \n") for _ in range(r.randint(60, 400))) for _ in range(5)]
    rows = []
    for i in range(60):
        k = r.random()
        b = b"a" * r.randint(0, 300) if k < 0.2 else (b"xy" * 200)[: r.randint(50, 400)] if k < 0.4 else b"".join(r.choice(base)[r.randint(0, 30) :][: r.randint(80, 300)] for _ in range(r.randint(1, 4)))
        rows.append((i, b.decode()))
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    want = repeats_by_force(rows)
    for x in repeats.query(spark, str(tmp_path)).collect():
        assert (x.n_bytes, x.n_removed, x.n_spans, x.kept_sha256) == want[x.doc_id]


def edits(a, b):
    """Edit distance of two lists, row by row."""
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]


def test_edit_distance_in_a_band():
    r = random.Random(3)
    for _ in range(600):
        a = [r.randint(0, 3) for _ in range(r.randint(0, 25))]
        b = [r.randint(0, 3) for _ in range(r.randint(0, 25))] if r.random() < 0.4 else [x for x in a if r.random() < 0.9 for x in [x] * r.choice([1, 1, 1, 1, 2])]
        most = r.randint(0, 14)
        assert neardup.edit_distance(np.array(a, np.uint64), np.array(b, np.uint64), most) == min(edits(a, b), most + 1)


def like(a, b):
    """Whether two texts are near duplicates by the definition: words and their edit distance, nothing of the library."""
    x, y = split(a), split(b)
    if (a or "") == (b or ""):
        return True
    longest = max(len(x), len(y))
    if not x or not y or longest - sum((Counter(x) & Counter(y)).values()) > 0.2 * longest + 1e-9:
        return False
    return edits(x, y) <= 0.2 * longest + 1e-9


def test_near_duplicates(spark, tmp_path):
    r = random.Random(4)
    base = [[words(r, 1) for _ in range(r.choice([4, 60, 200]))] for _ in range(25)]
    rows, n = [], 0
    for b in base:
        for _ in range(r.choice([1, 3, 12])):
            copy = list(b)
            for _ in range(r.randint(0, max(1, len(b) // 40))):
                copy[r.randrange(len(copy))] = "new" + words(r, 1)
            rows.append((n, " ".join(copy)))
            n += 1
    rows += [(n, None), (n + 1, ""), (n + 2, "  "), rows[0]]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = {x.doc_id: x.class_id for x in neardup.query(spark, str(tmp_path)).collect()}
    text = dict(rows)
    root = {i: i for i in text}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in text:
        for j in text:
            if i < j and like(text[i], text[j]):
                x, y = sorted((find(i), find(j)))
                root[y] = x
    assert got == {i: find(i) for i in text}
    kept = neardup.distinct(spark.read.parquet(f"{tmp_path}/documents.parquet")).collect()
    assert sorted(x.doc_id for x in kept) == sorted(set(got.values()))


def test_near_duplicates_that_no_leader_is_like(spark, tmp_path):
    r = random.Random(8)
    rows = []
    for cluster in range(12):
        base = [f"{cluster}w{k}" for k in range(200)]

        def changed(text, *places):
            return [f"{r.random()}" if k in places else w for k, w in enumerate(text)]

        copies = [changed(base, r.randrange(10, 190)) for _ in range(20)]
        near = changed(base, 100)
        rows += [(len(rows) + i, " ".join(t)) for i, t in enumerate([base, *copies, near, changed(near, 20, 50, 140, 170)])]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = {x.doc_id: x.class_id for x in neardup.query(spark, str(tmp_path)).collect()}
    assert got == {i: i - i % 23 for i, _ in rows}


def test_one_row_of_each_class_stays_under_null_and_equal_ids(spark):
    r = random.Random(12)
    texts = [words(r, 50) for _ in range(8)]
    rows = [(None, texts[0]), (None, texts[1]), (None, texts[2]), (None, texts[2]), (5, texts[3]), (5, texts[4]), (5, texts[4] + " more"), (5, texts[5]), (9, texts[5]), (None, texts[6]), (7, texts[6]), (None, None)]
    kept = neardup.distinct(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    got = sorted(((x.doc_id, (x.text or "").removesuffix(" more")) for x in kept), key=str)
    assert got == sorted([(None, texts[0]), (None, texts[1]), (None, texts[2]), (5, texts[3]), (5, texts[4]), (5, texts[5]), (7, texts[6]), (None, "")], key=str)


def test_linked_texts_share_one_of_their_rarest_words():
    r = random.Random(5)
    counts = np.random.default_rng(5).integers(0, 9, neardup.CELLS)
    met = 0
    for _ in range(400):
        x = [r.randint(1, 40) for _ in range(r.randint(1, 60))]
        y = [r.randint(1, 99) if r.random() < 0.12 else w for w in x if r.random() > 0.04]
        if y and edits(x, y) <= 0.2 * max(len(x), len(y)):
            a, b = (hashing.mix(np.array(t, np.uint64)) for t in (x, y))
            assert neardup.linked(a, b) and len(np.intersect1d(neardup.rarest(a, counts), neardup.rarest(b, counts)))
            met += 1
    assert met > 100


@pytest.mark.parametrize(("wide", "block"), [(0, 7), (0, 500), (30, 7), (4096, 7), (4096, 500)])
def test_members_of_a_bucket_meet_in_blocks_and_by_their_rarest_words(spark, monkeypatch, wide, block):
    r = random.Random(13)
    bases = [[r.randint(1, 4000) for _ in range(r.choice([12, 60, 150]))] for _ in range(12)]
    texts = [[r.randint(1, 4000) if r.random() < 0.1 else w for w in bases[i % 12]] for i in range(90)]
    hashes = [hashing.mix(np.array(t, np.uint64)).astype(np.uint32) for t in texts]
    node = [bytes([k, 7]) for k in range(90)]
    shared = {(b, k) for k in range(90) for b in (k % 12, 100, 101) if b < 100 or r.random() < 0.8}
    monkeypatch.setattr(neardup, "BLOCK", block)
    words = spark.createDataFrame([(node[k], bytearray(h.tobytes())) for k, h in enumerate(hashes)], "node binary, words binary")
    members = spark.createDataFrame([(b, node[k]) for b, k in shared], "bucket long, node binary")
    roots = spark.createDataFrame([(node[k], node[k % 12]) for k in range(0, 90, 5)], "node binary, root binary")
    root = {k: k % 12 if k % 5 == 0 else k for k in range(90)}
    got = [(bytes(x.a)[0], bytes(x.b)[0]) for x in neardup.alike(members, words, roots, wide).collect()]
    assert len(got) == len(set(got)) and all(a < b and root[a] != root[b] for a, b in got)
    together = {(a, b) for b in range(90) for a in range(b) if root[a] != root[b] and any((k, a) in shared and (k, b) in shared for k in [*range(12), 100, 101])}
    near = {(a, b) for a, b in together if edits(texts[a], texts[b]) <= 0.2 * max(len(texts[a]), len(texts[b]))}
    assert len(near) > 50 and near <= set(got) <= together


def test_near_duplicates_reach_pairs_of_low_shingle_similarity(spark, sf_dir):
    docs = common.table(spark, sf_dir, "documents").select("doc_id", "text").collect()
    got = {r.doc_id: r.class_id for r in neardup.query(spark, sf_dir).collect()}
    long = [(r.doc_id, r.text) for r in docs if len(split(r.text)) >= 20]
    pairs = [(i, j) for i, a in long for j, b in long if i < j and like(a, b)]
    assert pairs and sum(got[i] == got[j] for i, j in pairs) >= 0.9 * len(pairs)


def test_segments_equal_the_slow_definition():
    r = random.Random(6)
    for _ in range(200):
        score = [r.choice([-4.0, -1.0, -1.0, 2.0, 3.0]) for _ in range(r.randint(0, 25))]
        got = toxicity.segments(np.array(score))

        def slow(lo, hi):  # the best stretch, shortest and first, then both sides of it
            best = max(((sum(score[a:b]), -(b - a), -a) for a in range(lo, hi) for b in range(a + 1, hi + 1)), default=(0, 0, 0))
            if best[0] <= 0:
                return []
            a, b = -best[2], -best[2] - best[1]
            return [*slow(lo, a), (a, b, best[0]), *slow(b, hi)]

        assert [round(s, 6) for *_, s in got if s > 0] and sum(s for *_, s in got) or not any(s > 0 for s in score)
        assert max((s for *_, s in got), default=0) == pytest.approx(max((s for *_, s in slow(0, len(score))), default=0))
        assert len(got) == len(slow(0, len(score)))


def test_toxicity_held_out(spark, awkward):
    d = "/root/testdata/sf0.01"
    got = toxicity.query(spark, d).join(common.table(spark, d, "labels"), "doc_id").where("held_out").collect()
    toxic, clean = ([r.predicted for r in got if r.toxic == k] for k in (1, 0))
    assert len(toxic) >= 10 and np.mean(toxic) >= 0.6 and np.mean(clean) <= 0.05
    top, rows = awkward
    odd = toxicity.query(spark, top).collect()
    assert len(odd) == len(rows) and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in odd)


def test_passages_are_found_where_they_are():
    model = toxicity.Model({b"vile": 3.0, b"rot": 2.0, b"kind": -2.0}, 0.5, 1.0, 0.01, np.array([-3.0, 2.0, 1.0]))
    raw = b"all good here. You VILE, rot vile! so kind kind of you, \xc3\xa9 then vile"
    best, total, found = model.evidence(raw)
    assert [raw[a:b].lower() for a, b, _ in found] == [b"vile, rot vile", b"vile"] and best == max(x for *_, x in found) and total == pytest.approx(sum(x for *_, x in found))
    assert model.evidence(b"") == (0.0, 0.0, [])


def test_cotraining(spark, sf_dir, awkward):
    top, rows = awkward
    got = cotraining.query(spark, top).collect()
    assert len(got) == len(rows) and all(0 <= r.score <= 1 for r in got)
    docs = common.table(spark, top, "documents")
    assert cotraining.accepted(docs, common.table(spark, top, "labels")).columns == docs.columns


def test_cotraining_on_labels_that_it_has_not_seen(spark):
    docs, labels = (common.table(spark, "/root/testdata/sf0.01", n) for n in ("documents", "labels"))
    unseen = common.fold("doc_id", 5) == 1
    got = cotraining.scored(docs, cotraining.learn_from(docs, labels.where(~unseen))).join(labels.where(unseen), "doc_id").collect()
    good = [r._tm_score >= cotraining.KEEP for r in got if r.quality]
    bad = [r._tm_score < cotraining.KEEP for r in got if not r.quality]
    assert len(good) + len(bad) > 50 and np.mean(good) >= 0.95 and np.mean(bad) >= 0.7


def test_views_teach_each_other_over_the_whole_pool(spark):
    """Few labels, two weak views: what the pool adds must show."""
    rng = np.random.default_rng(2)
    y = rng.random(3000) < 0.7
    words = [" ".join(rng.choice(["calm", "plain", "even"] if rng.random() < 0.5 + 0.35 * (1 if t else -1) else ["loud", "odd", "torn"], 30)) for t in y]
    source = ["ab"[int(rng.random() < 0.5 + 0.4 * (1 if t else -1))] for t in y]
    docs = spark.createDataFrame([(i, w, "en", s, 1) for i, (w, s) in enumerate(zip(words, source))], "doc_id long, text string, lang string, source string, n_chars long")
    labels = spark.createDataFrame([(i, int(y[i])) for i in range(60)], "doc_id long, quality int")
    got = {r.doc_id: r._tm_score for r in cotraining.scored(docs, cotraining.learn_from(docs, labels)).collect()}
    assert np.mean([(got[i] >= 0.5) == y[i] for i in range(60, 3000)]) > 0.85


def test_cotraining_holds_labelled_rows_once_on_the_driver(spark):
    """Before: lists of bytes, their concatenation, doubles and a copy of these, over 5,900 bytes a row of 1,112."""
    n = 8000
    docs = spark.range(n).selectExpr("id AS doc_id", "concat('word', id % 97, ' calm ', if(id % 3 > 0, 'odd ', 'even '), id) AS text", "'en' AS lang", "substr('abc', 1 + cast(id % 3 AS int), 1) AS source")
    labels = spark.range(n).selectExpr("id AS doc_id", "if(id % 5 > 0 OR id % 3 > 0, 1, 0) AS quality")
    tracemalloc.start()
    model = cotraining.learn_from(docs, labels)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 3000 * n and np.abs(model.text.weights).max() > 0 and np.abs(model.metadata.weights).max() > 0


def test_metadata_is_ones_and_a_cell_of_each_column():
    x = cotraining.Metadata(np.frombuffer(cotraining.metadata_cells("en", None) + cotraining.metadata_cells(None, "web"), np.uint8).reshape(-1, 2))
    cell = lambda v: 1 + zlib.crc32(v.encode()) % (cotraining.CELLS - 1)
    assert [np.flatnonzero(row).tolist() for row in x[:]] == [[0, 1 + cell("en"), 1 + cotraining.CELLS], [0, 1, 1 + cotraining.CELLS + cell("web")]] and x[:].max() == 1 and x[1:].shape == (1, cotraining.META)


@pytest.mark.parametrize("rows", [1, 7, 400, 1000])
def test_logistic_fit_doesnt_depend_on_its_parts(rows):
    rng = np.random.default_rng(4)
    x = np.column_stack([np.ones(400), rng.normal(size=(400, 3))]).astype(np.float32)
    y = (x[:, 1] + rng.normal(size=400) > 0).astype(float)
    assert common.fit_logistic(x, y, rows=rows) == pytest.approx(common.fit_logistic(x.astype(float), y), abs=1e-9)


@pytest.mark.parametrize("labels", [[], [(1, 1, 1), (2, 1, 1)], [(1, 0, 0), (2, 0, 0)]])
def test_labels_of_one_kind_or_none(spark, awkward, tmp_path, labels):
    top, rows = awkward
    common.table(spark, top, "documents").coalesce(1).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(labels, LABELS).coalesce(1).write.parquet(f"{tmp_path}/labels.parquet")
    for query in (rules.query, toxicity.query, cotraining.query):
        assert query(spark, str(tmp_path)).count() == len(rows)


def test_nearest(spark, awkward):
    got = {}
    for r in nearest.query(spark, awkward[0]).collect():
        got.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    rows = [(r.vec_id, np.array(r.embedding)) for r in common.table(spark, awkward[0], "embeddings").collect() if r.vec_id is not None and r.embedding and len(r.embedding) == 16 and None not in r.embedding and np.isfinite(r.embedding).all() and any(r.embedding)]
    hit = total = 0
    for q, v in rows:
        if q % 100 == 0:
            want = sorted((float(np.sqrt(((x - v) ** 2).sum())), i) for i, x in rows if i != q)[:10]
            ours = sorted(got[q])
            assert [k for k, *_ in ours] == list(range(1, 11)) and [(s, i) for _, i, s in ours] == sorted((s, i) for _, i, s in ours)
            hit += len({i for _, i in want} & {i for _, i, _ in ours})
            total += 10
    assert set(got) == {q for q, _ in rows if q % 100 == 0} and hit / total >= 0.9
    assert [i for _, i, _ in sorted(got[0])] == list(range(1000, 1010))  # copies of the query: ties to the smaller id


def test_nearest_of_every_length_and_of_very_common_vectors(spark):
    rng = np.random.default_rng(4)
    common_one = rng.normal(size=8).tolist()
    rows = [(i, common_one) for i in range(0, 3000, 3)] + [(10_000 + i, rng.normal(size=8).tolist()) for i in range(200)] + [(20_000 + i, rng.normal(size=3).tolist()) for i in range(150)]
    got = {}
    for r in nearest.search(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect():
        got.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    for q, v in rows:
        if q % 100 == 0:
            want = sorted((float(np.sqrt(((np.array(x) - np.array(v)) ** 2).sum())), i) for i, x in rows if i != q and len(x) == len(v))[:10]
            if len(v) == 3 or q < 3000:  # no index, or copies
                assert [(s, i) for _, i, s in sorted(got[q])] == want
    assert set(got) == {q for q, _ in rows if q % 100 == 0}


def test_codes_within_a_radius_are_all_found():
    rng = np.random.default_rng(3)
    code = rng.integers(0, 2**63, 3000).astype(np.uint64)
    index = nearest.Index(code)
    for radius in (0, 5, 22, 27, 64):
        q = code[7] ^ np.uint64(5)
        assert index.within(q, radius).tolist() == np.flatnonzero(np.bitwise_count(code ^ q) <= radius).tolist()


def test_mixing(spark, awkward):
    top, rows = awkward
    got = mixing.query(spark, top).collect()
    sizes = Counter()
    for _, text, _, source, *_ in rows:
        sizes[source] += len(split(text))
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: (3, 1, 2)[k % 3] for k, s in enumerate(order)}
    target, open_, left = dict.fromkeys(order, 0.0), set(order), 1.5 * sum(sizes.values())
    while left > 1e-9 and open_:
        share = left / sum(weight[s] for s in open_)
        left = 0.0
        for s in sorted(open_, key=str):
            target[s] += share * weight[s]
            if target[s] >= 2 * sizes[s]:
                left += target[s] - 2 * sizes[s]
                target[s] = 2.0 * sizes[s]
                open_.discard(s)
    source = {}
    for i, _, _, s, *_ in rows:
        source[i] = s
    for r in got:
        assert r.target == pytest.approx(target[source[r.doc_id]]) and 0 <= r.taken <= 2 * r.size and (r.size == 0 or r.taken % r.size == 0)
    docs = common.table(spark, top, "documents")
    assert mixing.repeated(docs).columns == docs.columns
    assert sorted(map(str, got)) == sorted(map(str, mixing.query(spark, top).collect()))


def test_bpe_equals_the_library(spark, awkward):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(bpe.vocabulary())
    r = random.Random(1)
    encoder = bpe.encoder(bpe.vocabulary())
    odd = ["Hello wörld's 123 <|endoftext|>x  ﬀ ÉÈ", "a<|startoftext|><|endoftext|> b", "Σ ΣΑΣ. don't", "\x00́ a​b", "I'll 'S <|ENDOFTEXT|>", "=" * 300, "a" * 700, "İ ǅ ½²٣ \x1c\x85\xa0", "''''s'sll'll"]
    odd += ["".join(chr(r.choice([r.randint(1, 255), r.randint(97, 122), r.randint(0x300, 0x36F), r.randint(0x4E00, 0x4EFF)])) for _ in range(r.randint(1, 25))) for _ in range(400)]
    for s in odd:
        want = library.encode(s, add_special_tokens=False)
        got = [g for w in s.encode().split() if (g := encoder.of(w))[0]]
        assert b" ".join(g[1] for g in got).decode() == " ".join(map(str, want.ids))
    top, rows = awkward
    for x, (i, text, *_) in zip(sorted(bpe.query(spark, top).collect(), key=lambda x: str(x.doc_id)), sorted(rows, key=lambda x: str(x[0])), strict=True):
        want = library.encode(text or "", add_special_tokens=False)
        decoded = library.decode(want.ids, skip_special_tokens=False)
        assert (x.doc_id, x.n_tokens, x.ids_sha256, x.decoded_sha256) == (i, len(want.ids), hashlib.sha256(" ".join(map(str, want.ids)).encode()).hexdigest(), hashlib.sha256(decoded.encode()).hexdigest())


def test_pages(spark, awkward):
    rng = np.random.default_rng(77)
    model, wrong, total = pages.trained(), 0, 0
    for _ in range(60):
        page, kept = pages.generated(rng)
        found = pages.blocks(page)
        p = model.labels([pages.vectors(found)])[0]
        wrong += int(((p >= 0.5) != np.array([b.text in kept for b in found])).sum())
        total += len(found)
    assert wrong / total < 0.03
    for depth in (3, 10, 14, 20):  # boxes under elements that say nothing
        nest = lambda body: "<div>" * depth + body + "</div>" * depth  # noqa: B023, E731
        deep = f"<body><article><h1>The title here</h1><p>The first long sentence of the article, which has words.</p><p>And the second one, too.</p></article><aside class='sidebar'>{nest('<p>Other stories that you may like to read.</p>')}</aside><footer>{nest('<p>All rights reserved by us.</p>')}</footer></body>"
        found = pages.blocks(deep)
        p = model.labels([pages.vectors(found)])[0]
        assert [b.text for b, x in zip(found, p) if x >= 0.5] == ["The title here", "The first long sentence of the article, which has words.", "And the second one, too."]
    got = {r.url: r for r in pages.query(spark, awkward[0]).collect()}
    assert got["u0"].text == "a & b\nc d" and got["u1"].text == got["u2"].text == got["u4"].text == "" and all(r.n_chars == len(r.text) for r in got.values())


@pytest.mark.parametrize(
    "page, want",
    [
        ('<p>one <svg class="i"/> two</p><p>three</p>', ["one", "two", "three"]),
        ('<p>one <svg class="i"/> two</p><p>three</p><svg><text>x</text></svg><p>four</p>', ["one", "two", "three", "four"]),
        ("<p>a</p><svg><svg><text>x</text></svg><text>y</text></svg><p>b</p>", ["a", "b"]),
        ("<div>a<template><div>x</div><template>y</template>z</template>b</div>", ["a", "b"]),
        ("<p>a <select><option>x</p><p>b</p>", ["a", "b"]),
        ("<body>a<noscript><img src=x><p>b</p><select><option>x<option>y<p>c</p>", ["a", "b", "c"]),
        ("<div>a <svg><path d='m'> b<p>c</p><svg><title/><text>x</text></svg></div>", ["a", "c"]),
        ("<p>a</p><NOSCRIPT><p>x</p></NOSCRIPT><select><option>y</select><p>b</p>", ["a", "b"]),
        ("<p>a</p><script>'<svg>'</script><style>p{}</style><p>b</p>", ["a", "b"]),
    ],
)
def test_dropped_elements_end_where_they_end(page, want):
    assert [b.text for b in pages.blocks(page)] == want


def test_the_outermost_elements_of_a_deep_path_are_seen():
    inner = ("ul", "li") * 10
    comments, article = (pages._path_cells((f"div {name}", *inner)) for name in ("comments", "article"))
    assert np.abs(comments - article).max() > 0.1
    shallow = ("div a", "p")
    assert set(np.abs(pages._path_cells(shallow))) <= {0, 1, 2, 3}


def test_pipeline(spark, awkward):
    import corpus_pipeline

    docs = common.table(spark, awkward[0], "documents")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = common.stored(stage(spark, docs, awkward[0]))
        assert out.columns == docs.columns, name
        docs = out
    assert corpus_pipeline.STAGES[-1][1](spark, docs, awkward[0]).count() == docs.count()
