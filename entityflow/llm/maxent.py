"""Language-model scores by a hashed maximum-entropy model.

Targets are class-factored: P(w | h) = P(class | h) P(w | class). The ``WORDS`` most
frequent training tokens are dealt into ``CLASSES`` classes by the company they keep (sums
of random signs of the tokens before them, clustered); all other tokens are one
further class. The class softmax is log-linear in hashed features of the history: the
token before (n-gram), the token before that (skip) and the pair of their classes.
Inside a class a token has its smoothed training share.

Every observed pair (token before, token) is a sparse feature of its own, so what the
model knows grows with the corpus: the first factor of the softmax chooses between
pairs seen, with weight log n(before), and the class model, with weight log ``BACK``, and
P(w | h) = (n(before, w) + BACK P_class(w | h)) / (n(before) + BACK), which sums to 1.

Training is distributed: the first update takes the class weights from the observed
counts of the pair feature; in each of ``ROUNDS`` rounds after it every training
position adds its gradient (observed less expected class) to its three features, tasks
return sums in whole numbers, and weights move by the scaled gradient. Sums do
not depend on how the table is split, so neither do scores.

Counts of tokens and pairs are exact over all training tokens: those of the model's words are
broadcast with it, all others go by hash. A task sends the distinct keys of about ``FLUSH`` tokens, packed, into buckets of the hash space (their number
follows the input), a bucket sends back each key's total in the same order, and the
texts' tokens meet the totals in a second shuffle, where sparse numpy batches are scored.

``documents`` is a stored table: a task that is run again must see the same rows.

Edge cases: a null text is empty and has its end token only; a null id counts as
the text "" in the fold rule; repeated rows are scored each; without training
tokens every count is 0.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ._common import col, map_batches, map_rows, read, written
from .words import mix, word_hashes

WORDS, CLASSES, ROUNDS, RATE, BACK = (1 << 16) - 1, 31, 1, 0.6, 200
#: Number of a token that is none of the model's words, in two bytes.
OTHER = (1 << 16) - 1
#: Random signs a word is described by, three to a number; rows of a token feature.
SIGNS, BUCKETS = 15, 1 << 13
WIDTH = CLASSES + 1
#: Rows of all features: token before, token before that, pair of classes (CLASSES: other tokens, CLASSES + 1: before the text).
ROWS = 2 * BUCKETS + (CLASSES + 2) ** 2
#: Tokens of a numpy batch, of a flush, and of a counting task.
BATCH, FLUSH, BUCKET = 1 << 16, 1 << 19, 1 << 21
#: Expected counts are summed in units of 2^-15.
UNIT = 1 << 15
END = np.uint64(xxhash.xxh3_64_intdigest(b"\0end"))
START = np.uint64(xxhash.xxh3_64_intdigest(b"\0start"))
_K1, _K2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)


def held_out(doc_id) -> bool:
    return zlib.crc32(b"" if doc_id is None else str(doc_id).encode()) % 10 == 0


def token_counts(documents: DataFrame, text: str, id_col: str) -> DataFrame:
    """(h, c) of all training tokens, counted in the task before the shuffle."""
    def make():
        held: list[np.ndarray] = []
        state = [0, 0]

        def flush():
            if not held and not state[1]:
                return None
            h, c = np.unique(np.concatenate(held) if held else np.zeros(0, np.uint64), return_counts=True)
            h, c = np.append(h, END).view(np.int64), np.append(c, state[1])
            held.clear()
            state[:] = [0, 0]
            return [pa.array(h, pa.int64()), pa.array(c, pa.int64())]

        def f(ids, texts):
            found = word_hashes([t for i, t in zip(ids, texts) if not held_out(i)])
            held.extend(found)
            state[0] += sum(map(len, found))
            state[1] += len(found)
            return flush() if state[0] > 4_000_000 else None

        f.end = flush
        return f

    parts = map_rows(documents, [col(id_col).cast("string"), col(text)], make, "h long, c long")
    return parts.groupBy("h").agg(F.sum("c").alias("c"))


def tokens(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all tokens with an end behind each text, and where texts end."""
    rows = [np.append(h, END) for h in word_hashes(texts)]
    return np.concatenate(rows), np.cumsum([len(r) for r in rows])


def before(x: np.ndarray, ends: np.ndarray, start) -> tuple[np.ndarray, np.ndarray]:
    """Of each position what stands one and two places before it in its text, ``start`` before the text."""
    one, two = np.empty_like(x), np.empty_like(x)
    one[1:], two[2:] = x[:-1], x[:-2]
    starts = np.append(0, ends[:-1])
    second = starts[ends - starts > 1] + 1
    one[starts] = start
    two[starts] = start
    two[second] = start
    return one, two


class Words:
    """Numbers of the model's words by hash: three tables by different bits, the next for words whose slot is taken."""

    BITS = 18

    def __init__(self, h: np.ndarray):
        self.h = h
        left, self.levels = np.arange(len(h)), []
        for shift in (44, 24, 4):
            slot = self._slot(h[left], shift)
            table = np.full(1 << self.BITS, -1, np.int32)
            table[slot[::-1]] = left[::-1]
            more = np.zeros(1 << self.BITS, bool)
            out = table[slot] != left
            more[slot[out]] = True
            self.levels.append((shift, table, more))
            left = left[out]
        self.rest = left

    def _slot(self, h: np.ndarray, shift: int) -> np.ndarray:
        return ((h >> np.uint64(shift)) & np.uint64((1 << self.BITS) - 1)).astype(np.int64)

    def find(self, h: np.ndarray) -> np.ndarray:
        """Number of each token's word, -1 for others."""
        out = np.full(len(h), -1, np.int32)
        if not len(self.h):
            return out
        left = np.arange(len(h))
        for shift, table, more in self.levels:
            slot = self._slot(h[left], shift)
            got = table[slot]
            hit = (got >= 0) & (self.h[got] == h[left])
            out[left[hit]] = got[hit]
            left = left[~hit & more[slot]]
            if not len(left):
                return out
        for i in self.rest.tolist():
            out[left[h[left] == self.h[i]]] = i
        return out


class Model:
    """Words, classes, biases and weights: what the corpus fixes. Tables of fixed size."""

    def __init__(self, h: np.ndarray, c: np.ndarray, total: int, distinct: int):
        self.words, self.c, self.total, self.distinct = Words(h), c, total, distinct
        self.z = total + 0.1 * (distinct + 1)
        self.w = np.zeros((ROWS, WIDTH), np.float32)
        self.set_classes(np.zeros(len(h), np.int64))

    def set_classes(self, of: np.ndarray) -> None:
        self.class_of = np.append(of, CLASSES).astype(np.int64)  # number -1 is any other token
        self.mass = np.bincount(of, weights=self.c + 0.1, minlength=WIDTH)
        self.mass[CLASSES] = max(self.z - self.mass.sum(), 0.1)
        with np.errstate(divide="ignore"):
            self.bias = np.maximum(np.log(self.mass / self.z), -1e9).astype(np.float32)

    def features(self, h: np.ndarray, number: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Classes of the tokens and the rows (3, tokens) of their histories."""
        cls = self.class_of[number]
        one, two = before((h >> np.uint64(51)).astype(np.int64), ends, int(START >> np.uint64(51)))
        a, b = before(cls, ends, CLASSES + 1)
        return cls, np.stack([one, BUCKETS + two, 2 * BUCKETS + a * (CLASSES + 2) + b])

    def probabilities(self, rows: np.ndarray) -> np.ndarray:
        """P(class | history), one row a position.

        Weights are bounded (a log ratio to a class's share, and steps of 2 RATE a round), so exponents cannot overflow.
        """
        x = self.w[rows[0]]
        x += self.w[rows[1]]
        x += self.w[rows[2]]
        x += self.bias
        np.exp(x, out=x)
        x /= x.sum(axis=1, keepdims=True)
        return x

    def class_p(self, cls: np.ndarray, rows: np.ndarray) -> np.ndarray:
        out = np.empty(len(cls))
        for k in range(0, len(cls), BATCH):
            p = self.probabilities(rows[:, k : k + BATCH])
            out[k : k + BATCH] = p[np.arange(len(p)), cls[k : k + BATCH]]
        return out


# -- tables summed over the cluster, in whole numbers ------------------------------------
SUMS = "block int, sums binary"
_BLOCKS = 64


def _packed(x: np.ndarray) -> bytes:
    """Integers in the fewest bytes that hold them; the first byte says how many."""
    most = max(int(x.max()), -int(x.min()) - 1)
    n = next(n for n in (1, 2, 4, 8) if most < 1 << (8 * n - 1))
    return bytes([n]) + x.astype(f"<i{n}").tobytes()


def _unpacked(raw: bytes) -> np.ndarray:
    return np.frombuffer(raw, f"<i{raw[0]}", offset=1).astype(np.int64)


def _sum_blocks(batches):
    total: dict[int, np.ndarray] = {}
    for b in batches:
        for k, raw in zip(*[c.to_pylist() for c in b.columns]):
            x = _unpacked(raw)
            total[k] = total[k] + x if k in total else x
    if total:
        yield pa.RecordBatch.from_arrays([pa.array(list(total), pa.int32()), pa.array([_packed(x) for x in total.values()], pa.binary())], names=["block", "sums"])


def summed(documents: DataFrame, shared, add, shape: tuple[int, int], text: str, id_col: str) -> np.ndarray:
    """Sum over all training texts of what ``add(model, table, hashes, ends)`` adds to a table of integers."""
    def make():
        model = shared.value
        table = np.zeros(shape, np.int64)

        def f(ids, texts):
            if keep := [t for i, t in zip(ids, texts) if not held_out(i)]:
                add(model, table, *tokens(keep))
            return None

        def end():
            blocks = np.array_split(table.ravel(), _BLOCKS)
            return list(zip(*[(k, _packed(x)) for k, x in enumerate(blocks) if x.any()])) or None

        f.end = end
        return f

    parts = map_rows(documents, [col(id_col).cast("string"), col(text)], make, SUMS)
    # Two levels, so the parts that meet in a task grow slower than the number of tasks.
    salted = parts.withColumn("salt", F.pmod(F.spark_partition_id(), F.lit(16))).repartition("block", "salt").drop("salt")
    out = np.zeros(shape, np.int64)
    blocks = np.array_split(out.reshape(-1), _BLOCKS)  # views
    for r in map_batches(map_batches(salted, _sum_blocks, SUMS).repartition("block"), _sum_blocks, SUMS).toLocalIterator():
        blocks[r["block"]] += _unpacked(r["sums"])
    return out


_LANE = np.array([1.0, 2.0**16, 2.0**32])
#: Positions whose counts a lane of 16 bits holds.
_LANE_MOST = (1 << 16) - 1


def company(model: Model, table: np.ndarray, h: np.ndarray, ends: np.ndarray) -> None:
    """Adds to each word's column how often each sign of the two tokens before it is set, and how many there were."""
    number = model.words.find(h)
    known = np.append(number, -1)
    at = np.arange(len(h))
    words = table.shape[1]
    for near in before(at, ends, len(h)):
        m = np.flatnonzero((number >= 0) & (known[near] >= 0))
        for a in range(0, len(m), _LANE_MOST):
            p = m[a : a + _LANE_MOST]
            w, signs = number[p], mix(h[near[p]])
            table[SIGNS] += np.bincount(w, minlength=words)
            for k in range(0, SIGNS, 3):
                lanes = sum(((signs >> np.uint64(k + j)) & np.uint64(1)) * _LANE[j] for j in range(3))
                got = np.bincount(w, weights=lanes, minlength=words).astype(np.int64)
                for j in range(3):
                    table[k + j] += (got >> 16 * j) & 0xFFFF


def classes_of(model: Model, table: np.ndarray) -> np.ndarray:
    """Classes of the words: weighted k-means on the shares of signs, from the words that lie farthest apart."""
    n, c = len(model.c), model.c.astype(float)
    if not n:
        return np.zeros(0, np.int64)
    seen, signs = table[SIGNS, :n].astype(float), table[:SIGNS, :n].T
    mean = signs.sum(axis=0) / max(seen.sum(), 1)
    x = (signs + 10 * mean) / (seen + 10)[:, None] - mean
    _, axes = np.linalg.eigh((x * c[:, None]).T @ x)
    x = x @ axes[:, -8:]
    centre = [x[0]]
    far = ((x - x[0]) ** 2).sum(axis=1)
    while len(centre) < min(CLASSES, n):
        centre.append(x[int(np.argmax(far * c))])
        far = np.minimum(far, ((x - centre[-1]) ** 2).sum(axis=1))
    centre = np.array(centre)
    for _ in range(20):
        of = ((centre**2).sum(axis=1) - 2 * x @ centre.T).argmin(axis=1)
        weight = np.bincount(of, weights=c, minlength=len(centre))
        total = np.stack([np.bincount(of, weights=c * x[:, j], minlength=len(centre)) for j in range(x.shape[1])], axis=1)
        centre = np.where(weight[:, None] > 0, total / np.maximum(weight, 1e-300)[:, None], centre)
    return of


def observed(model: Model, table: np.ndarray, h: np.ndarray, ends: np.ndarray) -> None:
    """Adds every position's class to its three features; a class a row."""
    cls, rows = model.features(h, model.words.find(h), ends)
    for r in rows:
        table += np.bincount(cls * ROWS + r, minlength=table.size).reshape(table.shape)


#: First rows of the three features, and the end.
_RANGES = (0, BUCKETS, 2 * BUCKETS, ROWS)


def expected(model: Model, table: np.ndarray, h: np.ndarray, ends: np.ndarray) -> None:
    """Adds every position's class probabilities, in units, to its three features; a class a row."""
    _, rows = model.features(h, model.words.find(h), ends)
    for k in range(0, rows.shape[1], BATCH):
        batch = rows[:, k : k + BATCH]
        p = model.probabilities(batch)
        p *= UNIT
        by_class = np.ascontiguousarray(np.rint(p, out=p).T)
        for r, a, b in zip(batch, _RANGES, _RANGES[1:]):
            r = r - a
            for c, units in enumerate(by_class):  # sums of whole numbers below 2^53 are exact
                table[c, a:b] += np.bincount(r, weights=units, minlength=b - a).astype(np.int64)


def train(documents: DataFrame, model: Model, text: str, id_col: str) -> Model:
    """Classes, first weights from observed counts, then gradient rounds. Only tables of fixed size come to the driver and go back."""
    sc = documents.sparkSession.sparkContext

    def over(add, shape):
        shared = sc.broadcast(model)
        out = summed(documents, shared, add, shape, text, id_col)
        shared.unpersist()
        return out

    model.set_classes(classes_of(model, over(company, (SIGNS + 1, WORDS))))
    seen = over(observed, (WIDTH, ROWS)).T
    share = np.exp(model.bias.astype(float))
    pair = seen[2 * BUCKETS :].astype(float)
    with np.errstate(divide="ignore", invalid="ignore"):
        model.w[2 * BUCKETS :] = np.where(share > 0, np.log((pair + 20 * share) / (pair.sum(axis=1, keepdims=True) + 20) / share), 0)
    for _ in range(ROUNDS):
        e = over(expected, (WIDTH, ROWS)).T / UNIT
        model.w = model.w + (RATE * (seen - e) / (0.5 * (seen + e) + 4)).astype(np.float32)
    return model


def prepare(counts: DataFrame) -> Model:
    """The model's words: the most frequent ones by eighths of octaves of their counts, then by hash. A histogram of those says
    which rows to fetch, so little more than the words comes to the driver, however many tasks hold the counts."""
    total, distinct = counts.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count("*")).first()
    ranked = counts.withColumn("b", F.floor(8 * F.log2(F.col("c").cast("double"))).cast("int"))
    above, keep = 0, F.lit(True)
    for r in ranked.groupBy("b").agg(F.count("*").alias("n")).orderBy(F.desc("b")).collect():  # 512 rows at most
        if above + r["n"] > WORDS:
            share = min(1.0, 1.2 * (WORDS - above) / r["n"] + 1000 / r["n"])  # hashes are uniform
            keep = (F.col("b") > r["b"]) | ((F.col("b") == r["b"]) & (F.col("h") / 2.0**64 + 0.5 <= share))
            break
        above += r["n"]
    top = ranked.where(keep).toPandas()
    top = top.sort_values(["b", "h"], ascending=[False, True]).head(WORDS).sort_values(["c", "h"], ascending=[False, True])
    return Model(top["h"].to_numpy(np.int64).view(np.uint64), top["c"].to_numpy(np.int64), int(total), int(distinct))


# -- exact totals of all tokens and pairs -----------------------------------------------
PACKED = "bucket int, flush long, data binary"


def pair_keys(h: np.ndarray, ends: np.ndarray) -> np.ndarray:
    one, _ = before(h, ends, START)
    return mix(one * _K1 + h * _K2 + np.uint64(1))


def _counts(c: np.ndarray) -> bytes:
    """A byte each; larger ones behind them in eight bytes."""
    big = c[c >= 255].astype("<u8")
    return np.minimum(c, 255).astype(np.uint8).tobytes() + big.tobytes()


def _read_counts(raw: bytes, n: int, at: int = 0) -> np.ndarray:
    c = np.frombuffer(raw, np.uint8, n, at).astype(np.int64)
    if at + n < len(raw):
        c[c == 255] = np.frombuffer(raw, "<u8", offset=at + n).astype(np.int64)
    return c


class _Flushes:
    """Texts gathered into flushes, alike in both passes; a flush is named by what it holds."""

    def __init__(self, emit):
        self.emit, self.ids, self.found, self.size = emit, [], [], 0

    def __call__(self, ids, texts):
        self.ids += ids
        self.found += word_hashes(texts)
        self.size += sum(map(len, self.found[-len(ids) :])) + len(ids)
        return self.end() if self.size >= FLUSH else None

    def end(self):
        if not self.ids:
            return None
        h = np.concatenate([x for w in self.found for x in (w, (END,))]).astype(np.uint64)
        ends = np.cumsum([len(w) + 1 for w in self.found])
        name = xxhash.xxh3_64_intdigest(repr(self.ids).encode() + ends.tobytes() + h.tobytes()) >> 1
        out = self.emit(name, self.ids, h, ends)
        self.ids, self.found, self.size = [], [], 0
        return out


def _keys(documents: DataFrame, shared, buckets: int, text: str, id_col: str) -> DataFrame:
    """Distinct keys of a flush (the low seven bytes of each; the bucket has the high bits) and their training counts, by bucket.
    Keys are pairs, and tokens that are none of the model's words."""
    def make():
        words = shared.value.words

        def emit(flush, ids, h, ends):
            learn = np.repeat([not held_out(i) for i in ids], np.diff(ends, prepend=0))
            other = words.find(h) < 0
            u, at = np.unique(np.concatenate([h[other], pair_keys(h, ends)]), return_inverse=True)
            c = np.bincount(at[np.append(learn[other], learn)], minlength=len(u))
            bucket = ((u >> np.uint64(32)) * np.uint64(buckets)) >> np.uint64(32)
            cuts = np.flatnonzero(np.append(True, bucket[1:] != bucket[:-1])).tolist()
            low = np.ascontiguousarray(u.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :7])
            return list(zip(*[(int(bucket[a]), flush, (b - a).to_bytes(4, "little") + low[a:b].tobytes() + _counts(c[a:b])) for a, b in zip(cuts, [*cuts[1:], len(u)])]))

        return _Flushes(emit)

    return map_rows(documents, [col(id_col).cast("long"), col(text)], make, PACKED)


def _groups(batches, by: int):
    """Rows of neighbouring batches that agree in column ``by``."""
    at, held = None, []
    for b in batches:
        for row in zip(*[c.to_pylist() for c in b.columns]):
            if row[by] != at:
                if held:
                    yield at, held
                at, held = row[by], []
            held.append(row)
    if held:
        yield at, held


def _totals(batches):
    """One bucket at a time: each flush's keys' totals, in its order."""
    for bucket, rows in _groups(batches, 0):
        sizes = [int.from_bytes(r[2][:4], "little") for r in rows]
        key = np.zeros((sum(sizes), 8), np.uint8)
        key[:, :7] = np.concatenate([np.frombuffer(r[2], np.uint8, 7 * n, 4).reshape(n, 7) for r, n in zip(rows, sizes)])
        key = key.view("<u8").ravel()
        c = np.concatenate([_read_counts(r[2], n, 4 + 7 * n) for r, n in zip(rows, sizes)])
        order = np.argsort(key, kind="stable")
        k = key[order]
        starts = np.flatnonzero(np.append(True, k[1:] != k[:-1]))
        total = np.empty(len(k), np.int64)
        total[order] = np.repeat(np.add.reduceat(c[order], starts), np.diff(np.append(starts, len(k))))
        ends = np.cumsum(sizes).tolist()
        yield pa.RecordBatch.from_arrays([pa.array([bucket] * len(rows), pa.int32()), pa.array([r[1] for r in rows], pa.int64()), pa.array([(b - a).to_bytes(4, "little") + _counts(total[a:b]) for a, b in zip([0, *ends], ends)], pa.binary())], names=["bucket", "flush", "data"])


def _texts(documents: DataFrame, shared, text: str, id_col: str) -> DataFrame:
    """A flush's texts: ids, lengths, two bytes for each token (its word's number, OTHER for others), and the hashes and places of the others."""
    def make():
        words = shared.value.words

        def emit(flush, ids, h, ends):
            number = words.find(h)
            other = number < 0
            u, at = np.unique(h[other], return_inverse=True)
            some = np.array([i is not None for i in ids], np.uint8)
            head = np.array([len(ids), len(u), len(at)], np.int64).tobytes()
            place = np.ascontiguousarray(at.astype("<u4").view(np.uint8).reshape(-1, 4)[:, : 3 if len(u) < 1 << 24 else 4])
            parts = (some, np.array([i or 0 for i in ids], np.int64), np.diff(ends, prepend=0).astype(np.int64), u, np.where(other, OTHER, number).astype(np.uint16), place)
            return [[-1], [flush], [head + b"".join(x.tobytes() for x in parts)]]

        return _Flushes(emit)

    return map_rows(documents, [col(id_col).cast("long"), col(text)], make, PACKED)


SCORED = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double, score_per_token double"


def _scores(model: Model, rows: list) -> list:
    """Columns of SCORED of one flush: its texts and the totals of its keys from all buckets. Flushes that hold the same are one here, scored once each."""
    every = [r[2] for r in rows if r[0] < 0]
    raw, copies = every[0], len(every)
    rows = list({r[0]: r for r in rows if r[0] >= 0}.values())
    texts, words, others = np.frombuffer(raw, np.int64, 3).tolist()
    at = 24

    def take(kind, count):
        nonlocal at
        x = np.frombuffer(raw, kind, count, at)
        at += x.nbytes
        return x

    some, ids, size = take(np.uint8, texts).astype(bool), take(np.int64, texts), take(np.int64, texts)
    n, ends = int(size.sum()), np.cumsum(size)
    u, number = take(np.uint64, words), take(np.uint16, n).astype(np.int32)
    width = (len(raw) - at) // max(others, 1)
    place = np.zeros((others, 4), np.uint8)
    place[:, :width] = take(np.uint8, others * width).reshape(others, width)
    place = place.view("<u4").ravel()
    other = number == OTHER
    number[other] = -1
    h = np.empty(n, np.uint64)
    h[~other] = model.words.h[number[~other]]
    h[other] = u[place]
    pairs, pair_at = np.unique(pair_keys(h, ends), return_inverse=True)
    # places of both kinds of keys among all distinct keys of the flush, in order
    keys = np.concatenate([u, pairs])
    order = np.argsort(keys, kind="stable")
    rank = np.empty(len(keys), np.int64)
    rank[order] = np.cumsum(np.append(True, keys[order][1:] != keys[order][:-1])) - 1
    totals = np.concatenate([_read_counts(r[2], int.from_bytes(r[2][:4], "little"), 4) for r in sorted(rows, key=lambda r: r[0])])
    c = np.empty(n, np.int64)
    c[~other] = model.c[number[~other]]
    c[other] = totals[rank[: len(u)]][place]
    pair = totals[rank[len(u) :]][pair_at]
    cls, features = model.features(h, number, ends)
    share = (c + 0.1) / model.mass[cls]
    first, _ = before(np.arange(n), ends, n)
    seen = np.append(c, c[int(ends[0]) - 1])[first]  # before the text: as often as ends
    p = (pair + BACK * model.class_p(cls, features) * share) / (seen + BACK)
    starts = ends - size
    add = lambda x: np.add.reduceat(x, starts)  # noqa: E731  every text has its end token
    null, total = ~some, add(np.log10(p))
    out = [
        pa.array(ids, pa.int64(), mask=null), pa.array([held_out(i if s else None) for i, s in zip(ids.tolist(), some.tolist())], pa.bool_()), pa.array(size, pa.int64()),
        pa.array(add((c > 0).astype(np.int64)), pa.int64()), pa.array(np.full(texts, model.total), pa.int64()),
        pa.array(add(np.log10((c + 0.1) / model.z)), pa.float64()), pa.array(total, pa.float64()), pa.array(total / size, pa.float64()),
    ]
    return [pa.concat_arrays([x] * copies) for x in out]


def score(documents: DataFrame, model: Model, text: str = "text", id_col: str = "doc_id") -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score and score_per_token per row."""
    spark = documents.sparkSession
    shared = spark.sparkContext.broadcast(model)
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-model.total // BUCKET))
    keys = _keys(documents, shared, 4 * parts, text, id_col).repartition(parts, "bucket").sortWithinPartitions("bucket")
    both = map_batches(keys, _totals, PACKED).unionByName(_texts(documents, shared, text, id_col))

    def run(batches):
        for _, rows in _groups(batches, 1):
            yield pa.RecordBatch.from_arrays(_scores(shared.value, rows), names=[c.split()[0] for c in SCORED.split(", ")])

    out = map_batches(both.repartition(parts, "flush").sortWithinPartitions("flush"), run, SCORED, __name__)
    return out.withColumnRenamed("doc_id", id_col) if id_col != "doc_id" else out


def language_model_scores(documents: DataFrame, text: str = "text", id_col: str = "doc_id") -> DataFrame:
    """Counts, training and scores of a table."""
    counts = written(token_counts(documents, text, id_col), "lm-counts")
    return score(documents, train(documents, prepare(counts), text, id_col), text, id_col)


def op5_maxent(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_model_scores(read(spark, sf_dir, "documents"))


QUERIES = {"op5_maxent": op5_maxent}
ORACLES: dict[str, str] = {}
