"""BPE encoding by tree concatenation, and decoding.

A text is normalised, cut into words, and every word's symbols are encoded by
lowest-rank merging. An unsplit word longer than ``LEAF`` symbols is halved
until the parts are short; the parts are encoded on their own and joined
upwards: at each join a window of tokens around it is re-encoded, and it grows
until its first token is the left side's and its last token the right side's
own. All neighbouring pairs are then pairs that plain encoding leaves apart,
so the joined sequence is the encoding of the whole.

Texts longer than ``SPREAD`` characters, in which very long words can occur,
take a distributed route: their leaf chunks are encoded by different tasks and
one task per text only joins them.

Edge cases: null and empty texts have no ids and decode to ""; ids outside the
vocabulary raise; special strings in a text give their own id. Repeated rows
give repeated results; the id column may hold nulls.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import re
import unicodedata
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ._common import CACHES, RaggedMemo, col, map_rows, read

#: Symbols of a leaf, tokens of the first window at a join, characters from which a text is spread over tasks.
LEAF, WINDOW, SPREAD = 24, 4, 1 << 20
#: Memo entries (distinct words) a worker keeps.
MEMO = 250_000
_NONE = 1 << 40


def _byte_chars() -> list[str]:
    """Byte-level alphabet: printable Latin-1 bytes stand for themselves, the others take code points from 256 on, in order."""
    own = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b]
    out, extra = [], 256
    for b in range(256):
        if b in own:
            out.append(chr(b))
        else:
            out.append(chr(extra))
            extra += 1
    return out


class Vocabulary:
    """A byte-level BPE with word ends, read from a tokenizers file."""

    def __init__(self, path: str):
        import regex

        spec = json.load(open(path, encoding="utf-8"))
        model = spec["model"]
        if model["type"] != "BPE" or model.get("dropout") or spec.get("decoder") is not None:
            raise ValueError("not a plain BPE file without decoder")
        self.vocab: dict[str, int] = model["vocab"]
        self.end = model.get("end_of_word_suffix") or ""
        self.rank, self.made = {}, []
        for rank, pair in enumerate(model["merges"]):
            a, b = pair if isinstance(pair, list) else pair.split(" ")
            self.rank[self.vocab[a], self.vocab[b]] = rank
            self.made.append(self.vocab[a + b])
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.names = {i: t for t, i in self.vocab.items()} | {i: t for t, i in self.special.items()}
        self.cut = re.compile("|".join(map(re.escape, sorted(self.special, key=len, reverse=True)))) if self.special else None
        split = next(p for p in spec["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split")
        self.words = regex.compile(split["pattern"]["Regex"])
        chars = _byte_chars()
        self.first = [self.vocab[c] for c in chars]
        self.last = [self.vocab[c + self.end] for c in chars]
        self.inner: dict[int, list[int]] = {}  # a token's symbols
        back = {c: b for b, c in enumerate(chars)}
        for t, i in self.vocab.items():
            ends = bool(self.end) and t.endswith(self.end) and len(t) > len(self.end)
            body = t.removesuffix(self.end) if ends else t
            if all(c in back for c in body):
                raw = [back[c] for c in body]
                self.inner[i] = [self.first[b] for b in raw[:-1]] + [self.last[raw[-1]] if ends else self.first[raw[-1]]]

    # -- normalising and cutting ------------------------------------------------
    @staticmethod
    def normalise(text: str) -> str:
        """NFC, runs of white space to one space, lower case by character (no word-final rule)."""
        if text.isascii():
            return text.lower()
        low = text if text < "̀" and not _HIGH.search(text) else unicodedata.normalize("NFC", text)
        return low.lower() if "Σ" not in low else "".join(c.lower() for c in low)

    def symbols(self, word: str) -> list[int]:
        raw = word.encode()
        return [self.first[b] for b in raw[:-1]] + [self.last[raw[-1]]]

    # -- leaves -----------------------------------------------------------------
    def leaf(self, s: list[int]) -> list[int]:
        """Lowest rank first, leftmost among equals."""
        rank, made = self.rank, self.made
        s = list(s)
        r = [rank.get(p, _NONE) for p in zip(s, s[1:])]
        while r and (low := min(r)) < _NONE:
            i = r.index(low)
            s[i : i + 2] = [made[low]]
            del r[i]
            if i:
                r[i - 1] = rank.get((s[i - 1], s[i]), _NONE)
            if i < len(r):
                r[i] = rank.get((s[i], s[i + 1]), _NONE)
        return s

    def heap(self, s: list[int]) -> list[int]:
        """The same rule for long sequences, in n log n; the plain path that tests compare with."""
        n, s = len(s), list(s)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        queue = [(m, i, s[i], s[i + 1]) for i in range(n - 1) if (m := self.rank.get((s[i], s[i + 1]))) is not None]
        heapq.heapify(queue)
        while queue:
            low, i, a, b = heapq.heappop(queue)
            j = after[i]
            if s[i] != a or j >= n or s[j] != b:
                continue
            s[i], s[j] = self.made[low], -1
            after[i] = after[j]
            if after[i] < n:
                before[after[i]] = i
            for x, y in ((before[i], i), (i, after[i])):
                if x >= 0 and y < n and (m := self.rank.get((s[x], s[y]))) is not None:
                    heapq.heappush(queue, (m, x, s[x], s[y]))
        return [x for x in s if x >= 0]

    # -- joining ----------------------------------------------------------------
    def join(self, left: list[int], right: list[int]) -> list[int]:
        """Encoding of the symbols of both sides, from each side's own encoding."""
        if not left or not right:
            return left + right
        k = WINDOW
        while True:
            a, b = left[-k:], right[:k]
            inside = [x for t in a + b for x in self.inner[t]]
            window = self.leaf(inside) if len(inside) <= 2 * LEAF else self.heap(inside)
            whole_left, whole_right = k >= len(left), k >= len(right)
            if (whole_left or window[0] == a[0]) and (whole_right or window[-1] == b[-1]):
                return left[: max(0, len(left) - k)] + window + right[k:]
            k *= 2

    def encode_symbols(self, s: list[int]) -> list[int]:
        if len(s) <= LEAF:
            return self.leaf(s)
        half = len(s) // 2
        return self.join(self.encode_symbols(s[:half]), self.encode_symbols(s[half:]))

    def encode_word(self, word: str) -> list[int]:
        return self.encode_symbols(self.symbols(word))

    def encode_chunks(self, chunks: list[str]):
        """(flat ids, ids of each chunk); a chunk is normalised and holds no white space, or is a space and a special string."""
        rows = [[self.special[c[1:]]] if c[0] == " " else [i for w in self.words.findall(c) for i in self.encode_word(w)] for c in chunks]
        lens = np.fromiter(map(len, rows), np.int64, len(rows))
        return np.fromiter(chain.from_iterable(rows), np.int32, int(lens.sum())), lens

    def chunks(self, text: str) -> list[str]:
        """Normalised chunks between white space, special strings on their own.

        A full stop or comma behind a letter is cut off too: the word pattern ends a word there anyway, and it
        leaves fewer distinct chunks.
        """
        if not self.cut or "<" not in text or not self.cut.search(text):
            return _spaces(_STOP.sub(" ", self.normalise(text)))
        out: list[str] = []
        at = 0
        for m in [*self.cut.finditer(text), None]:
            out += _spaces(_STOP.sub(" ", self.normalise(text[at : m.start() if m else len(text)])))
            if m:
                out.append(" " + m[0])
                at = m.end()
        return out

    def encode_texts(self, texts: list[str], memo: RaggedMemo) -> list[np.ndarray]:
        flat, ends = memo.texts([self.chunks(t) for t in texts])
        return np.split(flat, ends[:-1]) if len(texts) else []

    def decode(self, ids: list[int]) -> str:
        """Without a decoder in the file, tokens are joined by spaces."""
        return " ".join(map(self.names.__getitem__, ids))


_HIGH = re.compile("[̀-\U0010ffff]")
_ODD = re.compile("[\x1c-\x1f]")
_STOP = re.compile("(?<=[a-z])(?=[,.])")


def _spaces(text: str) -> list[str]:
    """Chunks between white space as the pattern's white-space class has it (str.split also cuts at four separators that it lacks)."""
    return [c for c in re.split(r"[^\S\x1c-\x1f]+", text) if c] if _ODD.search(text) else text.split()


@lru_cache(4)
def vocabulary(path: str) -> Vocabulary:
    return Vocabulary(path)


@lru_cache(4)
def memo(path: str) -> RaggedMemo:
    """One memo a worker process, kept from task to task."""
    return RaggedMemo(vocabulary(path).encode_chunks, MEMO)


def _ids_array(rows: list) -> pa.Array:
    return pa.array(rows, pa.list_(pa.int32()))


def _encode_short(df: DataFrame, path: str) -> DataFrame:
    def make():
        v, known = vocabulary(path), memo(path)

        def f(keys, texts):
            flat, ends = known.texts([v.chunks(t or "") for t in texts])
            return [keys, pa.ListArray.from_arrays(pa.array(np.append(0, ends), pa.int32()), pa.array(flat, pa.int32()))]

        return f

    return map_rows(df, [F.col("key"), F.col("text")], make, "key string, ids array<int>", 256)


def _encode_spread(df: DataFrame, path: str, leaf_chars: int = 1 << 16) -> DataFrame:
    """Long texts: cut into chunk rows, encode chunks in parallel, join those of one word. A task holds one text's ids at most."""
    def cut():
        v = vocabulary(path)

        def f(keys, texts):
            rows = []
            for key, text in zip(keys, texts):
                n = at = 0
                for m in [*(v.cut.finditer(text) if v.cut else ()), None]:
                    for chunk in _spaces(v.normalise(text[at : m.start() if m else len(text)])):
                        for w in v.words.findall(chunk):
                            for k in range(0, len(w), leaf_chars):
                                part = w[k : k + leaf_chars]
                                if rows and rows[-1][0] == key and rows[-1][2] == 0 and k == 0 and len(w) <= leaf_chars and sum(map(len, rows[-1][3])) < leaf_chars:
                                    rows[-1][3].append(part)
                                else:  # kind 0: whole words; 1: part of a word that goes on; 2: its last part
                                    rows.append((key, n, 0 if len(w) <= leaf_chars else 2 if k + leaf_chars >= len(w) else 1, [part]))
                                    n += 1
                    if m:
                        rows.append((key, n, 3, [m[0]]))
                        n, at = n + 1, m.end()
                rows.append((key, n, 0, []))
            return list(zip(*rows))

        return f

    def leaves():
        v = vocabulary(path)

        def f(keys, ns, kinds, words):
            out = []
            for kind, ws in zip(kinds, words):
                if kind == 1:
                    out.append(v.encode_symbols([v.first[b] for w in ws for b in w.encode()]))
                elif kind == 3:
                    out.append([v.special[w] for w in ws])
                else:
                    out.append([i for w in ws for i in v.encode_word(w)])
            return [keys, ns, kinds, _ids_array(out)]

        return f

    def join(key, table):
        v = vocabulary(path)
        rows = sorted(zip(table["n"].to_pylist(), table["kind"].to_pylist(), table["ids"].to_pylist()))
        done: list[int] = []
        parts: list[list[int]] = []
        for _, kind, ids in rows:
            if kind in (1, 2):
                parts.append(ids)
                if kind == 2:
                    while len(parts) > 1:  # a tree of joins
                        parts = [v.join(parts[k], parts[k + 1]) if k + 1 < len(parts) else parts[k] for k in range(0, len(parts), 2)]
                    done += parts.pop()
            else:
                done += ids
        return pa.table({"key": pa.array([key[0].as_py()]), "ids": _ids_array([done])})

    chunks = map_rows(df, [F.col("key"), F.col("text")], cut, "key string, n int, kind int, words array<string>", 1)
    coded = map_rows(chunks.repartition("key", "n"), [F.col(c) for c in ("key", "n", "kind", "words")], leaves, "key string, n int, kind int, ids array<int>", 16)
    return coded.groupBy("key").applyInArrow(join, "key string, ids array<int>")


def encode(df: DataFrame, path: str, text: str = "text", id_col: str = "doc_id", spread: int = SPREAD) -> DataFrame:
    """id_col and ``ids array<int>`` per row. Equal long texts share one distributed encoding."""
    rows = df.select(col(id_col).alias("id"), F.coalesce(col(text), F.lit("")).alias("text"))
    kind = rows.schema["id"].dataType.simpleString()
    short = _encode_short(rows.where(F.length("text") <= spread).select(F.col("id").cast("string").alias("key"), "text"), path)
    long = rows.where(F.length("text") > spread).select(F.col("id").cast("string").alias("id"), "text", F.sha2("text", 256).alias("key"))
    coded = _encode_spread(long.groupBy("key").agg(F.first("text").alias("text")), path)
    both = short.unionByName(long.drop("text").join(coded, "key").select(F.col("id").alias("key"), "ids"))
    return both.select(F.col("key").cast(kind).alias(id_col), "ids")


def decode(df: DataFrame, path: str, ids: str = "ids", id_col: str = "doc_id") -> DataFrame:
    """id_col and the decoded ``text``; null ids decode to null."""
    def make():
        v = vocabulary(path)
        return lambda keys, rows: [keys, [None if r is None else v.decode(r) for r in rows]]

    kind = df.schema[id_col].dataType.simpleString()
    out = map_rows(df, [col(id_col).cast("string"), col(ids)], make, "key string, text string", 256)
    return out.select(F.col("key").cast(kind).alias(id_col), "text")


def op3_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    path = public_tokenizers.path("word_bpe_49k.json")

    def make():
        v = vocabulary(path)
        names = list(map(str, range(max(v.names) + 1)))

        def f(keys, rows):
            sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
            return [keys, [len(r) for r in rows], [sha(" ".join(map(names.__getitem__, r))) for r in rows], [sha(v.decode(r)) for r in rows]]

        return f

    coded = encode(read(spark, sf_dir, "documents"), path)
    return map_rows(coded, [F.col("doc_id"), F.col("ids")], make, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string", 256)


QUERIES = {"op3_bpe": op3_bpe}
ORACLES: dict[str, str] = {}
CACHES[__name__] = [memo.cache_clear, vocabulary.cache_clear]
