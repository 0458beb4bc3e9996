"""HTML extraction by a recurrent block labeller.

A page is cut into leaf blocks of text. Each block is a vector of its tag path (tags, classes and ids of the elements it stands in,
hashed), of its words (hashed) and of a few sizes; a bidirectional LSTM reads the page's blocks in both directions and says of each
whether it belongs to the article.
"""

from __future__ import annotations

import html as entities
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache, lru_cache

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import map_rows, sigmoid, table
from tidemark.llm.hashing import word_hashes

PATH, WORDS, SIZES = 160, 16, 6
INPUTS, HIDDEN = PATH + WORDS + SIZES, 20
#: Innermost elements of a path that count in full; those further out count by the inverse of their distance.
NEAR = 12
#: Generated pages that the labeller learns from, and passes over them.
PAGES, PASSES = 600, 6

# Elements by what they do to text.
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q s samp small span strike strong sub sup time tt u var wbr".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
DROPPED = frozenset("script style noscript template iframe textarea select option button svg canvas object title head".split())
RAW = ("script", "style", "iframe", "textarea", "title")
#: Dropped elements with others in them; where they have no end, the next element that ends a paragraph ends them.
NESTED = ("svg", "template", "noscript", "select")
CLOSES_P = frozenset("address article aside blockquote details div dl fieldset figure footer form h1 h2 h3 h4 h5 h6 header hr main menu nav ol p pre section table ul".split())

_TAG = re.compile(r"""<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>"']++|"[^"]*+"|'[^']*+')*+)>|<(/?)([a-zA-Z][^\s/>]*)([^>]*+)>|<[!?/][^>]*+>""", re.S)
_NAME = re.compile(r"""(?<![\w-])(?:class|id|role)\s*=\s*("[^"]*"|'[^']*'|[^\s>]+)""", re.I)
_PART = re.compile(r"[a-z]+")


@dataclass
class Block:
    text: str
    path: tuple[str, ...]  # open elements, the outermost first: tag, then the words of its class, id and role
    linked: int  # characters of text in links
    tag: str


def blocks(page: str) -> list[Block]:
    """Leaf blocks with text, in page order: what stands between starts and ends of elements that aren't inline."""
    out: list[Block] = []
    stack: list[tuple[str, str]] = []
    held: list[tuple[str, bool]] = []
    links = 0
    ends: dict[str, int] = {}

    def open_ended(i: int, at: int) -> bool:
        """Whether the open element can't reach beyond ``at``: no end of its kind follows, or it is an image, which holds no paragraphs."""
        tag = stack[i][0]
        if tag not in ends:
            ends[tag] = max((e.start() for e in re.finditer(rf"</{tag}\b", page, re.I)), default=-1)
        return ends[tag] < at or tag == "svg" and not any(t == "foreignobject" for t, _ in stack[i:])

    def flush() -> None:
        text = " ".join(entities.unescape("".join(t for t, _ in held)).split())
        if text:
            path = tuple(p for t, p in stack if t not in INLINE)
            tag = next((t for t, _ in reversed(stack) if t not in INLINE), "")
            linked = sum(len(t) for t, a in held if a)
            out.append(Block(text, path, min(linked, len(text)), tag))
        held.clear()

    at, n = 0, len(page)
    while at < n:
        m = _TAG.search(page, at)
        if m is None:
            held.append((page[at:], links > 0))
            break
        if m.start() > at:
            held.append((page[at : m.start()], links > 0))
        at = m.end()
        tag = (m[2] or m[5] or "").lower()
        if not tag:
            continue
        if m[1] or m[4]:
            if tag not in INLINE:
                flush()
            if any(t == tag for t, _ in stack):
                while True:
                    t, _ = stack.pop()
                    links -= t == "a"
                    if t == tag:
                        break
            continue
        closed_itself = (m[3] or m[6] or "").endswith("/")
        if tag in RAW and not (closed_itself and any(t == "svg" for t, _ in stack)):
            if tag not in INLINE:
                flush()
            end = re.compile(rf"</{tag}\b[^>]*>", re.I).search(page, at)
            at = end.end() if end else n
            continue
        if tag == "br":
            held.append((" ", False))
            continue
        if tag not in INLINE:
            flush()
            if tag in CLOSES_P or tag == "li":
                i = next((i for i, (t, _) in enumerate(stack) if t in NESTED and open_ended(i, at)), len(stack))
                links -= sum(t == "a" for t, _ in stack[i:])
                del stack[i:]
                closed = "p" if tag != "li" else "li"
                for i in range(len(stack) - 1, -1, -1):
                    if stack[i][0] == closed:
                        links -= sum(t == "a" for t, _ in stack[i:])
                        del stack[i:]
                        break
                    if stack[i][0] not in INLINE and stack[i][0] != "p":
                        break
        if tag in VOID or closed_itself:
            continue
        names = _NAME.findall(m[3] or m[6] or "")
        stack.append((tag, " ".join([tag, *_PART.findall(" ".join(names).lower())]) if names else tag))
        links += tag == "a"
    flush()
    return [b for b in out if not any(p.split(" ", 1)[0] in DROPPED for p in b.path)]


@lru_cache(20_000)
def _path_cells(path: tuple[str, ...]) -> np.ndarray:
    v = np.zeros(PATH, np.float32)
    weights: dict[str, float] = {}  # wrappers that come again add nothing
    for distance, element in zip(range(len(path), 0, -1), path, strict=True):
        tag, *names = element.split(" ")
        if tag not in ("html", "body"):
            for word in (f"<{tag}", *names, f"{tag}.{names[0] if names else ''}"):
                weights[word] = min(1.0, NEAR / distance)
    for word, weight in weights.items():
        h = zlib.crc32(word.encode())
        v[h % PATH] += weight if h >> 16 & 1 else -weight
    return np.clip(v, -3, 3)


def vectors(found: list[Block]) -> np.ndarray:
    """INPUTS for each block of a page."""
    n = len(found)
    out = np.zeros((n, INPUTS), np.float32)
    if not n:
        return out
    hashes = (word_hashes(" ".join(b.text for b in found).encode()) % np.uint64(WORDS)).astype(np.int64)
    counts = np.array([b.text.count(" ") + 1 for b in found])
    who = np.repeat(np.arange(n), counts)
    bag = np.bincount(who * WORDS + hashes, minlength=n * WORDS).reshape(n, WORDS)
    size = np.array([len(b.text) for b in found], float)
    out[:, :PATH] = [_path_cells(b.path) for b in found]
    out[:, PATH : PATH + WORDS] = bag / counts[:, None]
    out[:, PATH + WORDS :] = np.stack([np.log1p(size) / 6, np.log1p(counts) / 5, [b.linked / len(b.text) for b in found], [b.text[-1] in ".!?" for b in found], np.arange(n) / n, [b.tag in ("p", "h1", "h2", "h3", "blockquote", "pre") for b in found]], 1)
    return out


class Labeller:
    """A bidirectional LSTM with a logistic output for each block."""

    def __init__(self, seed: int = 3) -> None:
        rng = np.random.default_rng(seed)
        self.w = {}
        for d in "fb":
            self.w["x" + d] = rng.normal(0, 0.08, (INPUTS, 4 * HIDDEN)).astype(np.float32)
            self.w["h" + d] = rng.normal(0, 0.15, (HIDDEN, 4 * HIDDEN)).astype(np.float32)
            self.w["c" + d] = np.concatenate([np.zeros(HIDDEN), np.ones(HIDDEN), np.zeros(2 * HIDDEN)]).astype(np.float32)
        self.w["out"] = rng.normal(0, 0.1, 2 * HIDDEN + 1).astype(np.float32)

    def _run(self, x: np.ndarray, mask: np.ndarray, d: str, learn: bool) -> tuple[np.ndarray, list]:
        """x: time by page by INPUTS; pages that have ended keep their state. Only learning needs the tape of all steps."""
        steps, pages = mask.shape
        h = c = np.zeros((pages, HIDDEN), np.float32)
        a = x @ self.w["x" + d] + self.w["c" + d]
        out, tape = np.empty((steps, pages, HIDDEN), np.float32), []
        for t in range(steps):
            g = a[t] + h @ self.w["h" + d]
            i, f, o = (sigmoid(g[:, k * HIDDEN : (k + 1) * HIDDEN]) for k in range(3))
            u = np.tanh(g[:, 3 * HIDDEN :])
            m = mask[t][:, None]
            new = f * c + i * u
            bent = np.tanh(new)
            if learn:
                tape.append((h, c, i, f, o, u, bent))
            c = np.where(m, new, c)
            h = np.where(m, o * bent, h)
            out[t] = h
        return out, tape

    def forward(self, x: np.ndarray, mask: np.ndarray, learn: bool = False):
        f, tape_f = self._run(x, mask, "f", learn)
        b, tape_b = self._run(x[::-1], mask[::-1], "b", learn)
        both = np.concatenate([f, b[::-1], np.ones((*mask.shape, 1), np.float32)], 2)
        return sigmoid(both @ self.w["out"]), both, tape_f, tape_b

    def _back(self, x: np.ndarray, mask: np.ndarray, d: str, tape: list, gout: np.ndarray, grads: dict) -> None:
        pages = mask.shape[1]
        gh = gc = np.zeros((pages, HIDDEN), np.float32)
        ga = np.empty((len(tape), pages, 4 * HIDDEN), np.float32)
        hs = np.stack([t[0] for t in tape])
        for t in range(len(tape) - 1, -1, -1):
            _, c, i, f, o, u, th = tape[t]
            m = mask[t][:, None].astype(np.float32)
            gh_ = (gh + gout[t]) * m
            gnew = gc * m + gh_ * o * (1 - th * th)
            ga[t] = np.concatenate([gnew * u * i * (1 - i), gnew * c * f * (1 - f), gh_ * th * o * (1 - o), gnew * i * (1 - u * u)], 1)
            gc = gnew * f + gc * (1 - m)
            gh = ga[t] @ self.w["h" + d].T + (gh + gout[t]) * (1 - m)
        flat = ga.reshape(-1, 4 * HIDDEN)
        grads["x" + d] = x.reshape(-1, INPUTS).T @ flat
        grads["h" + d] = hs.reshape(-1, HIDDEN).T @ flat
        grads["c" + d] = flat.sum(0)

    def fit(self, pages: list[tuple[np.ndarray, np.ndarray]], passes: int = PASSES, size: int = 32, seed: int = 4) -> None:
        """Adam on the log-loss of (vectors, labels) pages."""
        rng = np.random.default_rng(seed)
        first = {k: np.zeros_like(v) for k, v in self.w.items()}
        second = {k: np.zeros_like(v) for k, v in self.w.items()}
        n = 0
        for p in range(passes):
            order = rng.permutation(len(pages))
            for at in range(0, len(order), size):
                part = [pages[i] for i in order[at : at + size]]
                x, mask = padded([v for v, _ in part])
                y = np.zeros(mask.shape, np.float32)
                for k, (_, label) in enumerate(part):
                    y[: len(label), k] = label
                prob, both, tape_f, tape_b = self.forward(x, mask, True)
                g = np.where(mask, prob - y, 0).astype(np.float32) / mask.sum()
                grads = {"out": np.tensordot(g, both, ([0, 1], [0, 1]))}
                gb = g[..., None] * self.w["out"][:-1]
                self._back(x, mask, "f", tape_f, gb[..., :HIDDEN], grads)
                self._back(x[::-1], mask[::-1], "b", tape_b, gb[::-1, :, HIDDEN:], grads)
                n += 1
                rate = 0.02 * (1 - p / passes) + 0.001
                for k, v in grads.items():
                    v = np.clip(v, -1, 1)
                    first[k] += 0.1 * (v - first[k])
                    second[k] += 0.01 * (v * v - second[k])
                    self.w[k] -= (rate * first[k] / (1 - 0.9**n) / (np.sqrt(second[k] / (1 - 0.99**n)) + 1e-7)).astype(np.float32)

    def labels(self, pages: list[np.ndarray]) -> list[np.ndarray]:
        """Probabilities for each block of each page; pages of like length run together."""
        out: list[np.ndarray] = [np.zeros(0)] * len(pages)
        order = sorted((i for i in range(len(pages)) if len(pages[i])), key=lambda i: len(pages[i]))
        at = 0
        while at < len(order):
            part = order[at : at + 128]
            while len(part) > 1 and len(pages[part[-1]]) > 2 * len(pages[part[0]]) + 8:
                part = part[: len(part) // 2]
            at += len(part)
            x, mask = padded([pages[i] for i in part])
            prob = self.forward(x, mask)[0]
            for k, i in enumerate(part):
                out[i] = prob[: len(pages[i]), k]
        return out


def padded(pages: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    steps = max(len(p) for p in pages)
    x, mask = np.zeros((steps, len(pages), INPUTS), np.float32), np.zeros((steps, len(pages)), bool)
    for k, p in enumerate(pages):
        x[: len(p), k], mask[: len(p), k] = p, True
    return x, mask


def generated(rng: np.random.Generator) -> tuple[str, set[str]]:
    """A page of random make, and the texts of its article's blocks. Every block's text is unlike the others'."""
    number = iter(range(10_000))

    def words(lo: int, hi: int, end: str = ".") -> str:
        k = int(rng.integers(lo, hi + 1))
        return " ".join("".join(chr(97 + c) for c in rng.integers(0, 26, int(rng.integers(2, 9)))) for _ in range(k)).capitalize() + f" {next(number)}" + end

    pick = lambda *options: options[int(rng.integers(len(options)))]
    often = lambda p: rng.random() < p

    def named(tag: str, *names: str) -> tuple[str, str]:
        name = pick(*names)
        kind = pick("class", "class", "id")
        return (f'<{tag} {kind}="{name}">', f"</{tag}>") if tag in ("div", "section", "ol") or often(0.5) else (f"<{tag}>", f"</{tag}>")

    def links(k: int) -> str:
        items = "".join(f'<li><a href="/{i}">{words(1, 3, pick("", "", "."))}</a></li>' for i in range(k))
        return f"<ul>{items}</ul>"

    def box(*names: str) -> str:
        a, b = named(pick("div", "div", "section", "aside"), *names)
        body = pick(words(3, 14), f"<p>{words(4, 25)}</p>", f"<h3>{words(1, 3, '')}</h3>{links(int(rng.integers(2, 6)))}", f"<p>{words(5, 25)}</p><p>{words(5, 25)}</p>", f'<a href="#">{words(3, 9)}</a>')
        return a + body + b

    menu = lambda: pick(f"<nav>{links(int(rng.integers(3, 9)))}</nav>", "".join([*named("div", "menu", "nav", "navbar", "navigation", "topnav", "breadcrumb", "breadcrumbs")][:1]) + links(int(rng.integers(3, 8))) + "</div>")
    head = lambda: "".join((a := named(pick("header", "header", "div"), "header", "site-header", "masthead", "top", "banner", "logo"))[:1]) + pick(f"<h1>{words(1, 4, '')}</h1>", f"<p>{words(2, 8, '')}</p>", words(1, 5, "")) + (menu() if often(0.4) else "") + a[1]
    foot = lambda: "".join((a := named(pick("footer", "footer", "footer", "div"), "footer", "site-footer", "copyright", "bottom"))[:1]) + pick(f"&copy; {words(2, 5, '')} &middot; {words(4, 14)}", f"<p>{words(3, 15)}</p>", links(4)) + a[1]
    advert = lambda: box("ad", "ads", "advert", "advertisement", "sponsored", "promo", "ad-banner", "adsbox", "banner-ad")
    side = lambda: pick(box("sidebar", "side", "related", "widget", "recommended", "popular", "more-stories"), f"<aside><p>{words(5, 25)}</p>{links(3)}</aside>", f"<aside>{words(5, 25)}</aside>")
    notice = lambda: box("cookie", "cookie-notice", "cookies", "consent", "notice", "alert", "popup", "modal", "newsletter", "subscribe", "gdpr", "share", "social")
    form = lambda: f"<form action='/s'><label>{words(1, 4, '')}</label><input name='q'><p>{words(2, 10)}</p></form>"

    def comments() -> str:
        a, b = named(pick("section", "div", "div", "ol"), "comments", "comment-list", "discussion", "responses", "replies", "reader-comments")
        body = "".join(f'<{t} class="comment"><p>{words(4, 40)}</p></{t}>' if often(0.7) else f"<p>{words(4, 40)}</p>" for t in [pick("div", "article", "li")] for _ in range(int(rng.integers(1, 6))))
        return a + (f"<h3>{words(1, 3, '')}</h3>" if often(0.5) else "") + body + b

    def wrapped(part: str) -> str:
        """Some layouts put elements that say nothing around everything."""
        k = int(rng.integers(1, 18)) if often(0.15) else 0
        tags = [pick("div", "div", "section", "span", "center") for _ in range(k)]
        names = ["", "", ' class="row"', ' class="col inner"', ' id="w"', ' class="wrap"']
        return "".join(f"<{t}{pick(*names)}>" for t in tags) + part + "".join(f"</{t}>" for t in reversed(tags))

    kept: set[str] = set()

    def own(text: str) -> str:
        kept.add(text)
        return text

    def article() -> str:
        a, b = pick(("<article>", "</article>"), ("<article>", "</article>"), ("<main>", "</main>"), named("div", "content", "article", "post", "entry-content", "story", "main", "article-body", "post-content", "text"), named("article", "post", "entry", "story"), ("<main><article>", "</article></main>"), ("<div>", "</div>"))
        body = [f"<h1>{own(words(2, 11, pick('', '.', '.')))}</h1>"] if often(0.85) else []
        style = pick("p", "p", "p", "div", "messy")
        for _ in range(int(rng.integers(1, 22))):
            k = rng.random()
            text = words(1, pick(8, 40, 120))
            if k < 0.06:
                body.append(f"<h2>{own(words(1, 6, ''))}</h2>")
            elif k < 0.10:
                body.append("<ul>" + "".join(f"<li>{own(words(2, 15))}</li>" for _ in range(int(rng.integers(2, 5)))) + "</ul>")
            elif k < 0.13:
                body.append(f"<blockquote>{own(text)}</blockquote>")
            elif k < 0.16:
                body.append(f"<pre>{own(text)}</pre>" if often(0.5) else f"<table><tr><td>{own(text)}</td><td>{own(words(1, 3))}</td></tr></table>")
            elif k < 0.20 and len(body) > 1:
                body.append(pick(advert, notice)() if often(0.6) else side())
            elif style == "messy" or k < 0.26:
                body.append(f"<p><b>{own(text)}<br>")
            else:
                body.append(f"<{style}>{own(text)}</{style}>")
        return a + "".join(body) + b

    before = [wrapped(f()) for f in (menu, head, advert, notice, side, form) if often(0.4)]
    after = [wrapped(f()) for f in (comments, side, advert, form, notice, menu) if often(0.3)]
    rng.shuffle(before)
    wrap = pick(("", ""), ("", ""), ('<div id="page">', "</div>"), ('<div class="container"><div class="row">', "</div></div>"))
    page = f"<!DOCTYPE html><html><head><title>{words(1, 6)}</title></head><body>{wrap[0]}{''.join(before)}{wrapped(article())}{''.join(after)}{wrapped(foot()) if often(0.8) else ''}{wrap[1]}"
    return page + ("</body></html>" if often(0.9) else ""), kept


@cache
def trained(pages: int = PAGES, passes: int = PASSES, seed: int = 11) -> Labeller:
    """The labeller, learned from generated pages; the same each time."""
    rng = np.random.default_rng(seed)
    known = []
    for _ in range(pages):
        page, kept = generated(rng)
        found = blocks(page)
        if found:
            known.append((vectors(found), np.array([b.text in kept for b in found], np.float32)))
    out = Labeller()
    out.fit(known, passes)
    return out


def extracted(rows: DataFrame, html: str = "html", keys: tuple[str, ...] = ("page_id", "url")) -> DataFrame:
    """(keys, text, n_chars) of every row: the blocks that the labeller keeps, joined by newlines.

    A null or empty page, and one without blocks or without any that is kept, has an empty text. Long pages are read whole. Rows that
    repeat are read alike; other columns are left out.
    """
    kinds = ", ".join(f"`{k}` {rows.schema[k].dataType.simpleString()}" for k in keys)
    model = trained()

    def texts(pages: Iterator[tuple]) -> Iterator[tuple]:
        held: list[tuple] = []
        size = 0

        def done() -> Iterator[tuple]:
            found = [blocks(h[-1] or "") for h in held]
            for h, page, p in zip(held, found, model.labels([vectors(b) for b in found]), strict=True):
                text = "\n".join(b.text for b, x in zip(page, p, strict=True) if x >= 0.5)
                yield *h[:-1], text, len(text)
            held.clear()

        for row in pages:
            held.append(row)
            size += len(row[-1] or "")
            if size > 4_000_000 or len(held) >= 512:
                yield from done()
                size = 0
        yield from done()

    return map_rows(rows.select(*(F.col(k) for k in keys), F.col(html).alias("_tm_html")), texts, f"{kinds}, text string, n_chars long", chunk=500)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extracted(table(spark, sf_dir, "pages"))
