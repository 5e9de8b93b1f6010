"""BPE encoding and decoding with a contiguous rank array.

A short word is held as two arrays side by side: its parts, one for each stretch between boundaries, and for each
boundary the rank of merging across it. The smallest rank is found by a scan, its boundary is deleted, and
only the ranks on both sides are looked up anew. Words of one length are the rows of a matrix, so a step is taken
for all of them at once, until none has a rank left. For words of more than SHORT parts, where repeated
scans would be quadratic, the same merges come off a heap.

The tokenizer is read from its public JSON file: NFC, white space to blanks, lower case, a split into
contractions, runs of letters, single digits and runs of other characters, then byte-level BPE with a
mark at the end of each word. Added special tokens are found in the raw text first. Texts are cut at white
space only, which the split drops anyway. Pieces of ASCII, letters of Latin-1 and common punctuation are split here; any
others are normalised and split by the library itself, whose Unicode tables are not those of Python. Merging is done
here in both cases.
Pieces are encoded once per worker and kept in a bounded cache.

Cases: a null text counts as empty: no tokens, and the hashes are those of the empty string. Very long
texts are hashed in stretches of STRETCH characters, cut at white space; a word without any needs memory in proportion
to itself. Each row of the input gives one row; null ids,
ties, repeated rows and further columns don't matter to the result. An empty table gives none. The work
is a map over the rows, so skew doesn't matter.
"""

from __future__ import annotations

import heapq
import json
import re
from collections.abc import Iterator
from hashlib import sha256
from itertools import chain, filterfalse

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, LongType, StringType, StructType

from folio.llm.shared import bounds, byte_alphabet, forget, small_batches

#: Parts up to which a word is merged by scans.
SHORT = 48
#: Pieces and words in a worker's cache.
CACHE = 500_000
#: Characters of text that are encoded at once, but for single longer pieces.
STRETCH = 1_000_000
_NEVER = 1 << 30
# white space of the split; str.split() also cuts at the four separators, which are no white space there
_SPACE = re.compile(r"[\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]+")
_SEPARATORS = "\x1c\x1d\x1e\x1f"
# what any two versions of Unicode agree on: letters that no mark follows, and no white space
_PLAIN = re.compile(r"[\x00-\x7f\xc0-\xd6\xd8-\xf6\xf8-\xff\u2010-\u2027\u2030-\u205e]*").fullmatch
_WORDS = re.compile("'s|'t|'re|'ve|'m|'ll|'d|[a-z\xdf-\xf6\xf8-\xff]+|[0-9]|\n|[^a-z\xdf-\xf6\xf8-\xff0-9\n]+").findall


class WordBPE:
    def __init__(self, path: str):
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        vocab: dict[str, int] = model["vocab"]
        self.suffix: str = model["end_of_word_suffix"] or ""
        merges = [tuple(m.split(" ", 1)) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.tokens = {i: t for t, i in (vocab | self.special).items()}
        # -1 ends a word or piece in lists that hold many
        self.names = {i: str(i) for i in self.tokens} | {-1: "\n"}
        self.shown = self.tokens | {-1: "\n"}
        self.special_re = re.compile("(" + "|".join(re.escape(t) for t in sorted(self.special, key=len, reverse=True)) + ")") if self.special else None
        library = Tokenizer.from_file(path)
        self.normalize, self.cut = library.normalizer.normalize_str, library.pre_tokenizer.pre_tokenize_str
        self.bytes = byte_alphabet()
        self.letters = {c: "".join(self.bytes[b] for b in chr(c).encode()) for c in (*range(0x21), *range(0x7F, 0x100), *range(0x2010, 0x205F))}
        # a part for each letter of the byte alphabet, within a word and at its end
        letters = max(map(ord, self.bytes)) + 1
        self.inner, self.last = np.zeros(letters, np.int64), np.zeros(letters, np.int64)
        for c in self.bytes:
            self.inner[ord(c)], self.last[ord(c)] = vocab[c], vocab[c + self.suffix]
        # pairs in order of their number, with rank and result
        pairs = np.array([(vocab[a], vocab[b]) for a, b in merges], np.int64).reshape(-1, 2)
        self.size = len(self.tokens) + max(self.tokens, default=0)
        number = pairs[:, 0] * self.size + pairs[:, 1]
        order = np.argsort(number, kind="stable")
        self.number, self.rank = np.append(number[order], np.int64(1) << 62), np.append(order, _NEVER)
        self.result = np.array([vocab[a + b] for a, b in merges], np.int64)
        self.clear()

    def clear(self) -> None:
        self.cache: dict[str, tuple[str, str]] = {t: (str(i), t) for t, i in self.special.items()}
        self.known: dict[str, tuple[str, str]] = {"\n": ("\n", "\n")}

    def _ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        number = left * self.size + right
        at = np.searchsorted(self.number, number)
        return np.where(self.number[at] == number, self.rank[at], _NEVER)

    def _scan(self, words: list[str]) -> list[int]:
        """The parts of words of one length, in the byte alphabet, after all merges, with -1 after each word."""
        codes = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32).reshape(len(words), -1)
        part = self.inner[codes]
        part[:, -1] = self.last[codes[:, -1]]
        out = np.full((len(words), part.shape[1] + 1), -1)
        left = np.full(len(words), part.shape[1])
        which = np.arange(len(words))
        now, rank = part, self._ranks(part[:, :-1], part[:, 1:])
        while rank.shape[1]:
            at = rank.argmin(1)
            low = rank[np.arange(len(rank)), at]
            go = low < _NEVER
            if not go.all():
                done = which[~go]
                out[done, : now.shape[1]], left[done] = now[~go], now.shape[1]
                which, now, rank, at, low = which[go], now[go], rank[go], at[go], low[go]
            if not len(which):
                break
            row = np.arange(len(which))
            # the boundary goes: what stands behind it moves up by one
            keep = np.ones(now.shape, bool)
            keep[row, at + 1] = False
            now = now[keep].reshape(len(row), -1)
            now[row, at] = self.result[low]
            keep = np.ones(rank.shape, bool)
            keep[row, at] = False
            rank = rank[keep].reshape(len(row), -1)
            r = np.flatnonzero(at < rank.shape[1])
            rank[r, at[r]] = self._ranks(now[r, at[r]], now[r, at[r] + 1])
            r = np.flatnonzero(at > 0)
            rank[r, at[r] - 1] = self._ranks(now[r, at[r] - 1], now[r, at[r]])
        out[which, : now.shape[1]], left[which] = now, now.shape[1]
        return out[np.arange(out.shape[1]) <= left[:, None]].tolist()

    def _heap(self, word: str) -> list[int]:
        parts = [*self.inner[[ord(c) for c in word[:-1]]].tolist(), int(self.last[ord(word[-1])])]
        n = len(parts)
        rank_of = lambda xs, ys: self._ranks(np.array(xs), np.array(ys)).tolist()
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(r, i, parts[i], parts[i + 1]) for i, r in enumerate(rank_of(parts[:-1], parts[1:])) if r < _NEVER]
        heapq.heapify(heap)
        while heap:
            rank, i, a, b = heapq.heappop(heap)
            j = after[i]
            if j >= n or parts[i] != a or parts[j] != b:
                continue
            parts[i], parts[j] = int(self.result[rank]), -1
            after[i] = after[j]
            if after[j] < n:
                before[after[j]] = i
            near = [(x, y) for x, y in ((before[i], i), (i, after[i])) if x >= 0 and y < n]
            if near:
                for (x, y), r in zip(near, rank_of([parts[x] for x, _ in near], [parts[y] for _, y in near]), strict=True):
                    if r < _NEVER:
                        heapq.heappush(heap, (r, x, parts[x], parts[y]))
        return [*(p for p in parts if p >= 0), -1]

    def merge(self, words: list[str]) -> list[tuple[str, str]]:
        """(ids, tokens), both joined by blanks, of each word of the split, written in the byte alphabet."""
        size = np.array([len(w) for w in words], np.int64)
        order = np.argsort(size, kind="stable")
        cut = bounds(size[order])
        flat: list[int] = []
        for a, b in zip(cut[:-1], cut[1:], strict=True):
            some = [words[k] for k in order[a:b].tolist()]
            if len(some[0]) <= SHORT:
                flat += self._scan(some)
            else:
                flat += chain.from_iterable(map(self._heap, some))
        out: list[tuple[str, str]] = [("", "")] * len(words)
        for k, pair in zip(order.tolist(), zip(self._joined(flat, self.names), self._joined(flat, self.shown), strict=True), strict=True):
            out[k] = pair
        return out

    @staticmethod
    def _joined(flat: list, names: dict) -> list[str]:
        return " ".join(map(names.__getitem__, flat[:-1])).split(" \n ") if flat else []

    def _others(self, pieces: list[str]) -> list[str]:
        """The words of these pieces as the library has them, with a line end after each piece. A word stands in the
        byte alphabet behind a line end, which tells it from a word of the other kind."""
        text = self.normalize(" ".join(pieces))
        ends = np.append(np.flatnonzero(np.frombuffer(text.encode("utf-32-le"), np.uint32) == 32), len(text)).tolist()
        out, k = [], 0
        for word, (start, _) in self.cut(text):
            while start > ends[k]:
                out.append("\n")
                k += 1
            out.append("\n" + word)
        return [*out, "\n"]

    def learn(self, pieces: list[str]) -> None:
        """Encodes pieces that the cache lacks."""
        plain, others = [], []
        for p in pieces:
            (plain if _PLAIN(p) else others).append(p)
        flat = _WORDS("\n".join(plain).lower()) + ["\n"] if plain else []
        for i in range(0, len(others), 1_000):
            flat += self._others(others[i : i + 1_000])
        words = list(dict.fromkeys(filterfalse(self.known.__contains__, flat)))
        spelt = [w[1:] if w[0] == "\n" else w if w.isascii() and w.isprintable() else w.translate(self.letters) for w in words]
        self.known.update(zip(words, self.merge(spelt), strict=True))
        found = list(map(self.known.__getitem__, flat[:-1]))
        ids, tokens = " ".join([x for x, _ in found]).split(" \n "), " ".join([y for _, y in found]).split(" \n ")
        self.cache.update(zip(plain + others, zip(ids, tokens, strict=True), strict=True))

    def pieces(self, text: str) -> list[str]:
        """The text between white space, and special tokens."""
        if self.special_re and "<|" in text:
            parts = self.special_re.split(text)
            return list(chain.from_iterable([part] if k % 2 else self._cut(part) for k, part in enumerate(parts)))
        return self._cut(text)

    def _cut(self, text: str) -> list[str]:
        if any(c in text for c in _SEPARATORS):
            return [p for p in _SPACE.split(text) if p]
        return text.split()

    def encode_all(self, texts: list[str]) -> list[tuple[str, str]]:
        """(ids, decoded text) of each text, both joined by blanks."""
        if len(self.cache) + len(self.known) > CACHE:
            self.clear()
        cut = [self.pieces(t) for t in texts]
        new = list(dict.fromkeys(filterfalse(self.cache.__contains__, chain.from_iterable(cut))))
        if new:
            self.learn(new)
        out = []
        for p in cut:
            found = list(map(self.cache.__getitem__, p))
            out.append((" ".join([x for x, _ in found]), " ".join([y for _, y in found])))
        return out

    def encode(self, text: str) -> tuple[str, str]:
        return self.encode_all([text])[0]

    def decode(self, ids: list[int]) -> str:
        """Without a decoder in the file, tokens are joined by blanks; unknown ids are left out."""
        return " ".join(self.tokens[i] for i in ids if i in self.tokens)


_loaded: dict[str, WordBPE] = {}
forget.append(_loaded.clear)


def tokenizer(path: str) -> WordBPE:
    """One for each worker process."""
    if path not in _loaded:
        _loaded[path] = WordBPE(path)
    return _loaded[path]


def stretches(text: str, most: int) -> Iterator[str]:
    """The text in parts of about `most` characters, cut at white space, where no piece or special token goes on."""
    at = 0
    while len(text) - at > most and (end := _SPACE.search(text, at + most)):
        yield text[at : end.start()]
        at = end.end()
    yield text[at:]


def _encoded(bpe: WordBPE, texts: list[str]) -> Iterator[tuple[str, list[str]]]:
    """(ids, stretches of the decoded text) of each text; short texts are encoded together."""
    i = 0
    while i < len(texts):
        j, n = i, 0
        while j < len(texts) and n + len(texts[j]) <= STRETCH:
            n += len(texts[j])
            j += 1
        if j > i:
            yield from ((ids, [decoded]) for ids, decoded in bpe.encode_all(texts[i:j]))
            i = j
            continue
        parts = [x for x in map(bpe.encode, stretches(texts[i], STRETCH)) if x[0]]
        yield " ".join([ids for ids, _ in parts]), [d for _, d in parts]
        i += 1


def _decoded_digest(parts: list[str]) -> str:
    out = sha256()
    for k, part in enumerate(parts):
        if k:
            out.update(b" ")
        out.update(part.encode())
    return out.hexdigest()


def encode(docs: DataFrame, path: str, keep: list[str], text: str = "text") -> DataFrame:
    """The columns `keep`, and n_tokens, ids (array<int>) and decoded_sha256, the digest of the text that the ids
    give back, which stays in the worker. `keep` may not have their names."""
    small_batches(docs.sparkSession)
    schema = StructType(docs.select(*keep).schema.fields).add("n_tokens", LongType()).add("ids", ArrayType(IntegerType())).add("decoded_sha256", StringType())
    if len(set(schema.names)) < len(schema.names):
        raise ValueError(f"a column to keep has a result's name: {keep}")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        bpe = tokenizer(path)
        for pdf in batches:
            for i in range(0, len(pdf), 200):
                out = pdf[keep].iloc[i : i + 200].reset_index(drop=True)
                made = [(np.fromstring(ids, np.int32, sep=" "), _decoded_digest(parts)) for ids, parts in _encoded(bpe, [t or "" for t in pdf["__text"].iloc[i : i + 200]])]
                out["n_tokens"] = [len(ids) for ids, _ in made]
                out["ids"] = [ids for ids, _ in made]
                out["decoded_sha256"] = [d for _, d in made]
                yield out

    return docs.select(*keep, F.col(text).alias("__text")).mapInPandas(run, schema)


def digests(docs: DataFrame, path: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, n_tokens, ids_sha256, decoded_sha256): ids and decoded texts stay in the worker."""
    small_batches(docs.sparkSession)
    kind = docs.schema[key].dataType.simpleString()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        bpe = tokenizer(path)
        for pdf in batches:
            rows = [(ids.count(" ") + 1 if ids else 0, sha256(ids.encode()).hexdigest(), _decoded_digest(parts)) for ids, parts in _encoded(bpe, [t or "" for t in pdf["t"]])]
            out = pd.DataFrame(rows, columns=["n_tokens", "ids_sha256", "decoded_sha256"])
            out.insert(0, key, pdf["k"])
            yield out

    return docs.select(F.col(key).alias("k"), F.col(text).alias("t")).mapInPandas(run, f"`{key}` {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string")


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def op5_word_bpe(spark, sf_dir: str) -> DataFrame:
    return digests(spark.read.parquet(f"{sf_dir}/documents.parquet"), default_path())
