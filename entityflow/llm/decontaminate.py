"""Benchmark decontamination with spaced seeds.

A seed mask looks at some of the words of a window and ignores the others, so a
window still matches after a substitution at an ignored place. Hashes of the
benchmark's masked windows are the index; every document's windows are hashed
with the same masks and looked up; each hit names a benchmark item and a
diagonal, along which document and item are compared word by word. A match
counts 1, a mismatch -2; runs are the maximal scoring segments of that comparison
(no part of the ends of one scores 0 or less). The overlap is the best run of those that match at least
``min(MIN_WORDS, 80 % of the item)`` words, which makes it contamination.

Words are ASCII-lower-cased and lose punctuation at their ends. Items of up to ``SHORT``
words have masks over their whole length whose ignored places cover every set
of as many places as the item may lack, so none of their overlaps is missed; documents are
padded for windows that reach over their ends. Longer items are found by the seeds
(measured recall: see the tests).

The index is a stated query set: it goes to the executors in blocks of at most
``INDEX_WORDS`` benchmark words (8 bytes a hash and mask). Documents are scanned once a
block, one block after the other: a block's result is written and its broadcast
dropped before the next, so one block is broadcast at a time.

Edge cases: null and empty texts and items match nothing; repeated items or
rows give a row each; a null doc_id stays null; empty tables give no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache
from itertools import combinations

import numpy as np
from pyspark.sql import DataFrame, SparkSession

from ._common import CACHES, col, drop, map_rows, map_whole, read, written
from .words import WEIGHTS, mix, word_hashes

#: Care positions (1) of the seeds; weight 7 in spans of 10 and 11 words.
MASKS = ("1110110101", "1101010111", "11010011101")
MIN_WORDS, SHORT = 12, 11
INDEX_WORDS = 2_000_000
#: Pairs of a document's place and an index posting that are held at once.
PAIRS = 1 << 20
_FILTER_BITS = 22


def masked(words: np.ndarray, mask: str) -> np.ndarray:
    """Hash of every window under the mask."""
    n = len(words) - len(mask) + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    h = np.full(n, np.uint64(len(mask)))
    for i, c in enumerate(mask):
        if c == "1":
            h += words[i : i + n] * WEIGHTS[i]
    return mix(h)


def _lacks(n: int) -> int:
    """Words that may differ in an item of n words."""
    return n - min(MIN_WORDS, -(-8 * n // 10))


@cache
def short_masks(n: int) -> tuple[str, ...]:
    """Masks of length n: for any ``_lacks(n)`` places one of them ignores all those. Greedy covering, three to six places of care."""
    lack = _lacks(n)
    ignored = n - max(3, min(6, n - 2 * lack)) if lack else 0
    left, out = set(combinations(range(n), lack)), []
    sets = list(combinations(range(n), ignored))
    while left:
        best = max(sets, key=lambda s: sum(c in left for c in combinations(s, lack)))
        left -= set(combinations(best, lack))
        out.append("".join("0" if i in best else "1" for i in range(n)))
    return tuple(out)


class Index:
    """Benchmark words and, per mask, sorted window hashes with their item and place."""

    def __init__(self, items: list[tuple[int | None, str | None]]):
        self.items = list(zip([i for i, _ in items], word_hashes([t for _, t in items], strip=True)))
        short = sorted({len(w) for _, w in self.items if 0 < len(w) <= SHORT})
        self.tables = []
        self.filter = np.zeros(1 << _FILTER_BITS, bool)
        for m, whole in [*((m, False) for m in MASKS), *((m, True) for n in short for m in short_masks(n))]:
            hs, ks, ps = [], [], []
            for k, (_, w) in enumerate(self.items):
                if whole and len(w) != len(m):
                    continue
                h = masked(w, m)
                hs.append(h)
                ks.append(np.full(len(h), k))
                ps.append(np.arange(len(h)))
            h = np.concatenate(hs) if hs else np.zeros(0, np.uint64)
            if len(h):
                order = np.argsort(h, kind="stable")
                self.tables.append((m, _lacks(len(m)) if whole else 0, h[order], np.concatenate(ks)[order], np.concatenate(ps)[order]))
                self.filter[h >> np.uint64(64 - _FILTER_BITS)] = True

    def _diagonals(self, words: np.ndarray) -> Iterator[np.ndarray]:
        """Codes item * 2^32 + diagonal + 2^31 of all hits."""
        for m, pad, table, ks, ps in self.tables:
            h = masked(np.pad(words, pad) if pad else words, m)
            at = np.flatnonzero(self.filter[h >> np.uint64(64 - _FILTER_BITS)])
            if not len(at):
                continue
            lo, hi = np.searchsorted(table, h[at], "left"), np.searchsorted(table, h[at], "right")
            hit = np.flatnonzero(hi > lo)
            at, lo, n = at[hit] - pad, lo[hit], (hi - lo)[hit]
            ends = np.cumsum(n)
            a = 0
            while a < len(at):
                b = max(a + 1, int(np.searchsorted(ends, ends[a] - n[a] + PAIRS, "right")))
                to = np.repeat(lo[a:b] - (ends[a:b] - n[a:b]), n[a:b]) + np.arange(ends[a] - n[a], ends[b - 1])
                yield np.unique((ks[to] << 32) + (np.repeat(at[a:b], n[a:b]) - ps[to] + (1 << 31)))
                a = b

    def overlaps(self, words: np.ndarray) -> Iterator[tuple[int, int, int, int]]:
        """(item index, first document word, words, matched words) of the best overlap with each item that is hit."""
        found = list(self._diagonals(words)) if len(words) else []
        best: dict[int, tuple[int, int, int]] = {}
        for code in np.unique(np.concatenate(found)).tolist() if found else ():
            k, d = code >> 32, (code & 0xFFFFFFFF) - (1 << 31)
            got = _run(words, self.items[k][1], d)
            if got[2] > best.get(k, (0, 0, 0))[2]:
                best[k] = got
        for k, (start, length, matched) in best.items():
            if matched >= _need(self.items[k][1]):
                yield k, start, length, matched


def _need(item: np.ndarray) -> int:
    return min(MIN_WORDS, -(-8 * len(item) // 10))


def _runs(same: np.ndarray) -> list[tuple[int, int, int]]:
    """(score, start, end) of all maximal scoring segments (Ruzzo and Tompa), over stretches of equal outcome."""
    edges = [0, *(np.flatnonzero(same[1:] != same[:-1]) + 1).tolist(), len(same)]
    out: list[tuple[int, int, int, int]] = []  # score before, score behind, start, end
    score = 0
    for a, b in zip(edges, edges[1:]):
        if not same[a]:
            score -= 2 * (b - a)
            continue
        low, score = score, score + b - a
        while True:
            j = next((j for j in range(len(out) - 1, -1, -1) if out[j][0] < low), -1)
            if j < 0 or out[j][1] >= score:
                break
            low, _, a, _ = out[j]
            del out[j:]
        out.append((low, score, a, b))
    return [(high - low, a, b) for low, high, a, b in out]


def _run(words: np.ndarray, item: np.ndarray, d: int) -> tuple[int, int, int]:
    """Best run along a diagonal, of those with enough matched words if there are any: first document word, length, matched words."""
    lo, hi = max(0, -d), min(len(item), len(words) - d)
    same = words[lo + d : hi + d] == item[lo:hi]
    total = np.concatenate([[0], np.cumsum(np.where(same, 1, -2))])
    low = np.minimum.accumulate(total)
    end = int(np.argmax(total - low))
    start = int(np.flatnonzero(total[: end + 1] == low[end])[-1])
    matched, need = int(same[start:end].sum()), _need(item)
    if matched < need <= int(same.sum()):  # a run of a lower score can still have enough
        enough = [(s, -a, b) for s, a, b in _runs(same) if int(same[a:b].sum()) >= need]
        if enough:
            _, start, end = max(enough)
            start = -start
            matched = int(same[start:end].sum())
    return lo + d + start, end - start, matched


def _blocks(benchmark: DataFrame, item: str, text: str, most: int) -> Iterator[list]:
    """The benchmark in blocks of bounded size, streamed to the driver one at a time."""
    block, size = [], 0
    for r in benchmark.select(col(item).cast("long").alias("i"), col(text).alias("t")).toLocalIterator():
        if r["t"]:
            block.append((r["i"], r["t"]))
            size += len(r["t"]) // 4 + 1
        if size >= most:
            yield block
            block, size = [], 0
    if block:
        yield block


HITS = "doc_id long, item_id long, start_word long, n_words long, n_matched long, item_words long"


def overlaps(documents: DataFrame, benchmark: DataFrame, text: str = "text", id_col: str = "doc_id", item: str = "item_id", item_text: str = "text", index_words: int = INDEX_WORDS) -> DataFrame:
    """One row per document row and benchmark item that it overlaps."""
    spark = documents.sparkSession
    out = last = None
    for block in _blocks(benchmark, item, item_text, index_words):
        if last is not None:  # there are several: each block's rows are written before the next is sent
            done = written(part, "leaks")
            last.destroy()
            out = done if out is None else out.unionByName(done)
        last = shared = spark.sparkContext.broadcast(block)

        def make(shared=shared):
            index = _index(shared)

            def f(ids, texts):
                rows = [(i, index.items[k][0], s, n, m, len(index.items[k][1])) for i, w in zip(ids, word_hashes(texts, strip=True)) for k, s, n, m in index.overlaps(w)]
                return list(zip(*rows)) if rows else None

            return f

        part = map_rows(documents, [col(id_col).cast("long"), col(text)], make, HITS)
    if last is None:
        out = spark.createDataFrame([], HITS)
    else:
        out = part if out is None else out.unionByName(part)
    return out.withColumnRenamed("doc_id", id_col) if id_col != "doc_id" else out


_CACHE: dict = {}


def _index(shared) -> Index:
    """Built once a worker and block."""
    key = ("index", shared._path if hasattr(shared, "_path") else id(shared))
    if key not in _CACHE:
        _CACHE.clear()
        _CACHE[key] = Index(shared.value)
    return _CACHE[key]


def clean_documents(documents: DataFrame, benchmark: DataFrame, text: str = "text", index_words: int = INDEX_WORDS) -> DataFrame:
    """The rows that overlap no benchmark item, with all their columns; one map pass a block, no shuffle."""
    spark = documents.sparkSession
    out, last, kept = documents, None, None
    at = documents.columns.index(text)
    for block in _blocks(benchmark, "item_id", "text", index_words):
        if last is not None:  # there are several: what the blocks before leave is written before the next is sent
            before, names = kept, out.columns
            kept = written(out.toDF(*[f"c{i}" for i in range(len(names))]), "clean")
            out = kept.toDF(*names)
            last.destroy()
            if before is not None:
                drop(before)
        last = shared = spark.sparkContext.broadcast(block)

        def run(batches, shared=shared):
            import pyarrow as pa

            index = _index(shared)
            for whole in batches:
                for k in range(0, whole.num_rows, 512):
                    b = whole.slice(k, 512)
                    keep = [next(index.overlaps(w), None) is None for w in word_hashes(b.column(at).to_pylist(), strip=True)]
                    yield b.filter(pa.array(keep, pa.bool_()))

        out = map_whole(out, run)
    return out


def op1_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per contaminated document and benchmark item."""
    return overlaps(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


QUERIES = {"op1_decontaminate": op1_decontaminate}
ORACLES: dict[str, str] = {}
CACHES[__name__] = [_CACHE.clear]
