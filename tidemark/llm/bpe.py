"""BPE encoding and decoding by dynamic programming over prefixes.

For every prefix of a word there is just one token that its encoding can end with. A suffix automaton over the vocabulary names the
tokens that end at a position; the one that may follow the last token of the prefix before it is stored, and the back-pointers from
the word's end give its ids. No merge is ever replayed.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from functools import cache

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import keep, map_rows, table, utf8

#: Words kept per Python worker, in each of two generations.
CACHE = 300_000
END = "</w>"
#: A word's last character is moved up by this, so that "ends a word" is part of the alphabet.
LAST = 0x1000
Found = tuple[int, bytes, bytes]


class SuffixAutomaton:
    """The substrings of all tokens; end[state] is the longest token that is a suffix of the state's strings, up[...] the next shorter."""

    def __init__(self, strings: list[str]) -> None:
        self.go: list[dict[str, int]] = [{}]
        self.link, self.length = [-1], [0]
        token_at: dict[int, int] = {}
        for i, s in enumerate(strings):
            last = 0
            for c in s:
                last = self._extend(last, c)
            token_at[last] = i
        order = sorted(range(len(self.go)), key=self.length.__getitem__)
        self.own = [token_at.get(s, -1) for s in range(len(self.go))]
        self.shorter = [-1] * len(self.go)  # the nearest state up the links that is a token
        for s in order[1:]:
            up = self.link[s]
            self.shorter[s] = up if self.own[up] >= 0 else self.shorter[up]

    def tokens(self, s: int) -> list[int]:
        """Tokens that end where the state does, longest first."""
        out = []
        while s > 0:
            if self.own[s] >= 0:
                out.append(self.own[s])
            s = self.shorter[s]
        return out

    def _state(self, length: int) -> int:
        self.go.append({})
        self.link.append(0)
        self.length.append(length)
        return len(self.go) - 1

    def _split(self, p: int, c: str, q: int) -> int:
        go, link, length = self.go, self.link, self.length
        clone = self._state(length[p] + 1)
        go[clone] = go[q].copy()
        link[clone], link[q] = link[q], clone
        while p >= 0 and go[p].get(c) == q:
            go[p][c] = clone
            p = link[p]
        return clone

    def _extend(self, last: int, c: str) -> int:
        go, link, length = self.go, self.link, self.length
        if (q := go[last].get(c)) is not None:
            return q if length[q] == length[last] + 1 else self._split(last, c, q)
        new, p = self._state(length[last] + 1), last
        while p >= 0 and c not in go[p]:
            go[p][c] = new
            p = link[p]
        if p >= 0:
            q = go[p][c]
            link[new] = q if length[q] == length[p] + 1 else self._split(p, c, q)
        return new


class PrefixEncoder:
    """Encodes and decodes words of one tokenizer file (BPE with word ends)."""

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer

        spec = json.load(open(path, encoding="utf-8"))
        vocab: dict[str, int] = spec["model"]["vocab"]
        self.token = {i: t for t, i in vocab.items()}
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.token |= {i: t for t, i in self.special.items()}
        library = Tokenizer.from_file(path)
        self.normalise, self.split = library.normalizer.normalize_str, library.pre_tokenizer.pre_tokenize_str
        # The character that stands for each byte, and the Latin-1 reading of the file's splitting pattern.
        plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
        others = (b for b in range(256) if b not in set(plain))
        self.char = {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(others)}
        self.latin = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-zªµºß-öø-ÿ]+|[0-9²³¹¼-¾]|[^\t-\r \x85\xa0a-zªµºß-öø-ÿ0-9²³¹¼-¾]+")
        self.special_at = re.compile("|".join(map(re.escape, sorted(self.special, key=len, reverse=True))) or r"(?!)")

        ids = sorted(i for i in vocab.values())
        texts = [self._own(self.token[i]) for i in ids]
        self.rank: dict[tuple[int, int], int] = {}
        self.parts: dict[int, tuple[int, int, int]] = {}
        for r, pair in enumerate(spec["model"]["merges"]):
            a, b = pair if isinstance(pair, list) else pair.split(" ")
            whole = vocab.get(a + b)
            if a in vocab and b in vocab and whole is not None:
                self.rank[vocab[a], vocab[b]] = r
                self.parts.setdefault(whole, (vocab[a], vocab[b], r))
        self.sound_memo: dict[int, bool] = {}
        self.follows_memo: dict[int, bool] = {}
        automaton = SuffixAutomaton(texts)
        self.go, self.link, self.lengths = automaton.go, automaton.link, automaton.length
        self.cut = {i: len(t) for i, t in zip(ids, texts, strict=True)}
        self.ending = [tuple((ids[k], len(texts[k])) for k in automaton.tokens(s) if self.sound(ids[k])) for s in range(len(self.go))]
        self.words: list[dict[bytes, Found]] = [{}, {}]
        self.pieces: list[dict[str, Found]] = [{}, {}]

    @staticmethod
    def _own(token: str) -> str:
        body = token.removesuffix(END) if token != END else token
        return body if body == token else body[:-1] + chr(LAST + ord(body[-1]))

    def _edge(self, token: int, side: int, until: float) -> list[tuple[int, int, float]]:
        """What stands at the token's edge as it is merged: (token, made at rank, merged away at rank)."""
        out = []
        while True:
            left, right, made = self.parts.get(token, (-1, -1, -1))
            out.append((token, made, until))
            if made < 0:
                return out
            token, until = (left, right)[side], made

    def _apart(self, a: int, b: int, until: float) -> bool:
        """Whether no merge joins the end of a to the start of b before rank ``until``. Of equal pairs the left one merges first."""
        ends, starts = self._edge(a, 1, until), self._edge(b, 0, until)
        for x, made_x, gone_x in ends:
            for y, made_y, gone_y in starts:
                r = self.rank.get((x, y))
                if r is not None and made_x < r < gone_x and made_y < r <= gone_y and r < until:
                    return False
        return True

    def sound(self, token: int) -> bool:
        """Whether the token's own text is encoded as the token."""
        known = self.sound_memo.get(token)
        if known is None:
            a, b, r = self.parts.get(token, (-1, -1, -1))
            known = self.sound_memo[token] = r < 0 or (self.sound(a) and self.sound(b) and self._apart(a, b, r))
        return known

    def follows(self, a: int, b: int) -> bool:
        if len(self.follows_memo) > 4 * CACHE:
            self.follows_memo.clear()
        known = self.follows_memo[a << 20 | b] = self._apart(a, b, float("inf"))
        return known

    def piece(self, chars: str) -> list[int]:
        """Ids of a pre-token, given as byte characters."""
        if not chars:
            return []
        word = chars[:-1] + chr(LAST + ord(chars[-1]))
        follows, memo, cut = self.follows, self.follows_memo, self.cut
        go, link, lengths, ending = self.go, self.link, self.lengths, self.ending
        state = length = i = 0
        last = [-1]
        for c in word:
            i += 1
            to = go[state].get(c)
            while to is None and state:
                state = link[state]
                length = lengths[state]
                to = go[state].get(c)
            if to is None:
                state = length = 0
            else:
                state = to
                length += 1
            found = -1
            for token, n in ending[state]:
                if n <= length:
                    if i == n:
                        found = token
                        break
                    before = last[i - n]
                    if before >= 0:
                        ok = memo.get(before << 20 | token)
                        if ok or (ok is None and follows(before, token)):
                            found = token
                            break
            last.append(found)
        out, i = [], len(word)
        while i:
            out.append(last[i])
            i -= cut[last[i]]
        return out[::-1]

    def _found(self, ids: list[int]) -> Found:
        return len(ids), " ".join(map(str, ids)).encode(), self.decode(ids).encode()

    def _piece(self, chars: str) -> Found:
        young, old = self.pieces
        got = young.get(chars)
        if got is None:
            got = old.get(chars)
            if got is None:
                got = self._found(self.piece(chars))
            if len(young) >= CACHE:
                self.pieces = [young := {}, young]
            if len(chars) <= 64:
                young[chars] = got
        return got

    def _plain(self, text: str) -> list[Found]:
        if text.isascii() or max(text) < "\u0100":  # in Latin-1 nothing composes, and lower case is a character each
            return [self._piece(p if p.isalnum() and p.isascii() else p.encode().decode("latin-1").translate(self.char)) for p in self.latin.findall(text.lower())]
        return [self._piece(p) for p, _ in self.split(self.normalise(text))]

    def word(self, text: str) -> list[Found]:
        """What text without ASCII white space is encoded as (normalisation and splitting never reach across white space)."""
        out, at = [], 0
        for m in self.special_at.finditer(text):
            out += [*self._plain(text[at : m.start()]), self._found([self.special[m[0]]])]
            at = m.end()
        return out + self._plain(text[at:] if at else text)

    def of(self, raw: bytes) -> Found:
        """(number of ids, the ids as text, the decoded text) of a word; both texts are b"" if there are no ids."""
        young, old = self.words
        got = young.get(raw)
        if got is None:
            got = old.get(raw)
            if got is None:
                parts = self.word(raw.decode("utf-8", "replace"))
                got = parts[0] if len(parts) == 1 else (sum(p[0] for p in parts), b" ".join([p[1] for p in parts]), b" ".join([p[2] for p in parts]))
            if len(young) >= CACHE:
                self.words = [young := {}, young]
            if len(raw) <= 64:
                young[raw] = got
        return got

    def decode(self, ids: list[int]) -> str:
        """The file names no decoder: tokens are joined by one space."""
        return " ".join(map(self.token.__getitem__, ids))


@cache
def encoder(path: str) -> PrefixEncoder:
    return PrefixEncoder(path)


def encode(docs: DataFrame, path: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_tokens, ids, decoded) of every row: ids as decimal text joined by one space, decoded as the file's decoder gives it.

    A null text is encoded as empty; a text without tokens gives 0, "" and "". Rows that repeat are encoded one by one; other columns
    of docs don't matter. Texts are split at ASCII white space into words, which each worker keeps with their ids, so that neither a
    text nor the vocabulary of the corpus is held beyond one batch and two bounded generations of words.
    """

    def rows(docs: Iterator[tuple]) -> Iterator[tuple]:
        keep("bpe", encoder.cache_clear)
        of = encoder(path).of
        last: tuple = (None, ())
        for key, raw in docs:
            if raw == last[0]:  # copies of a row often follow it
                yield key, *last[1]
                continue
            got = [g for w in raw.split() if (g := of(w))[0]]
            last = raw, (sum(g[0] for g in got), b" ".join([g[1] for g in got]), b" ".join([g[2] for g in got]))
            yield key, *last[1]

    out = map_rows(docs.select(F.col(doc_id).alias("doc_id"), utf8(text).alias("text")), rows, f"doc_id {docs.schema[doc_id].dataType.simpleString()}, n_tokens long, ids binary, decoded binary", chunk=500, owner="bpe")
    return out.select("doc_id", "n_tokens", F.col("ids").cast("string"), F.col("decoded").cast("string"))


def digests(encoded: DataFrame) -> DataFrame:
    return encoded.select("doc_id", "n_tokens", F.sha2(F.col("ids").cast("binary"), 256).alias("ids_sha256"), F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))


def vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digests(encode(table(spark, sf_dir, "documents"), vocabulary()))
