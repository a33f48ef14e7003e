"""Toxicity by cumulative-link ordinal regression on sparse text features.

Features are the words of a text and their prefixes, present or not, hashed
without a vocabulary file. The model is P(grade >= k) = sigmoid(w.x - b_k) with one
weight vector for all thresholds b_1 <= b_2 <= b_3; its output is the expected
severity, the sum of those probabilities (0 to 3).

The labels only say toxic or not, so grades are made in two steps: a first fit
with one threshold scores the labelled texts, and the toxic ones are graded 1 to
3 by thirds of that score; the ordinal model is then fitted on grades 0 to 3.

Fitting uses a bounded sample: ``FIT_ROWS`` labelled documents, chosen by hash of
their id over the whole label table. Features that fewer than ``MIN_ROWS`` of them
hold or that do not separate the classes (two-proportion z below ``MIN_Z``) are left
out. Scoring covers every document, in numpy batches.

Edge cases: null and empty texts have no features and so the severity of the
intercepts; labels of unknown documents and null labels are ignored; repeated
rows are scored each; without labels of both classes nothing is toxic.
"""

from __future__ import annotations

import re

import numpy as np
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ._common import col, map_batches, map_rows, map_whole, read

FIT_ROWS, MIN_ROWS, MIN_Z = 16_384, 8, 4.0
GRADES = 4
PREFIXES = (4, 5, 6)
_WORD = re.compile(r"[^\W\d_]+")
#: Distinct words a worker remembers.
MEMO = 150_000


def _features(word: str) -> tuple[int, ...]:
    """Hashes of a word and its prefixes."""
    kinds = [("w", word), *((f"p{n}", word[:n]) for n in PREFIXES if len(word) > n)]
    return tuple(xxhash.xxh32_intdigest(f"{k} {s}") for k, s in kinds)


class _Memo(dict):
    """word -> features, or with a model the places of those that it knows."""

    def __init__(self, known=None):
        super().__init__()
        self.known = known

    def __missing__(self, word: str):
        if len(self) > MEMO:
            self.clear()
        fs = _features(word)
        got = self[word] = fs if self.known is None else tuple(self.known[f] for f in fs if f in self.known)
        return got


def text_features(text: str | None, memo: _Memo) -> set[int]:
    if not text:
        return set()
    out: set[int] = set()
    for fs in map(memo.__getitem__, set(_WORD.findall(text.lower()))):
        if fs:
            out.update(fs)
    return out


class Model:
    def __init__(self, weights: dict[int, float], cuts: list[float]):
        self.weights, self.cuts = weights, cuts
        self.place = {f: i for i, f in enumerate(weights)}
        self.values = np.array([*weights.values(), 0.0])

    def severity(self, texts: list[str | None], memo: _Memo) -> tuple[np.ndarray, np.ndarray]:
        """Expected severities and probabilities of grade 1 or more of a batch; ``memo`` is one of this model's ``place``."""
        found = [text_features(t, memo) for t in texts]
        lens = np.fromiter(map(len, found), np.int64, len(found))
        flat = np.fromiter((f for x in found for f in sorted(x)), np.int64, int(lens.sum()))
        starts = np.cumsum(lens) - lens
        z = np.where(lens > 0, np.add.reduceat(np.append(self.values[flat], 0.0), starts), 0.0) if len(found) else np.zeros(0)
        p = 1 / (1 + np.exp(-np.clip(z[:, None] - np.array(self.cuts), -50, 50)))
        return p.sum(axis=1), p[:, 0]


def fit_ordinal(rows: list[np.ndarray], grades: np.ndarray, n_features: int, n_grades: int, steps: int = 300, l2: float = 1e-4, rate: float = 0.3) -> tuple[np.ndarray, np.ndarray]:
    """Weights and ordered thresholds by full-batch Adam on the ordinal likelihood (thresholds as a start and positive gaps)."""
    lens = np.array([len(r) for r in rows])
    flat = np.concatenate(rows) if len(rows) else np.zeros(0, np.int64)
    of = np.repeat(np.arange(len(rows)), lens)
    w, cut = np.zeros(n_features), np.concatenate([[1.0], np.zeros(n_grades - 2)])
    m, v = np.zeros(n_features + n_grades - 1), np.zeros(n_features + n_grades - 1)
    sig = lambda x: 1 / (1 + np.exp(-np.clip(x, -40, 40)))
    weight = np.ones(len(rows))
    for t in range(1, steps + 1):
        gaps = np.concatenate([[cut[0]], np.exp(cut[1:])])
        b = np.cumsum(gaps)
        z = np.bincount(of, weights=w[flat], minlength=len(rows))
        above = np.concatenate([np.ones((len(rows), 1)), sig(z[:, None] - b), np.zeros((len(rows), 1))], axis=1)
        at = np.arange(len(rows))
        p = np.maximum(above[at, grades] - above[at, grades + 1], 1e-9)
        slope = above * (1 - above)
        dz = -weight * (slope[at, grades] - slope[at, grades + 1]) / p
        db = np.zeros((len(rows), n_grades + 1))
        db[at, grades] += weight * slope[at, grades] / p
        db[at, grades + 1] -= weight * slope[at, grades + 1] / p
        gb = db[:, 1:-1].sum(axis=0)
        gcut = np.cumsum(gb[::-1])[::-1] * np.concatenate([[1.0], gaps[1:]])
        g = np.concatenate([np.bincount(flat, weights=dz[of], minlength=n_features), gcut]) / max(1, len(rows))
        g[:n_features] += l2 * w
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        step = rate * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)
        w, cut = w - step[:n_features], cut - step[n_features:]
    return w, np.cumsum(np.concatenate([[cut[0]], np.exp(cut[1:])]))


def fit(texts: list[np.ndarray], toxic: np.ndarray) -> Model:
    """Feature choice, first fit, grades of the toxic texts, ordinal fit. texts: distinct features of each."""
    toxic = np.asarray(toxic, bool)
    if not len(texts) or toxic.all() or not toxic.any():
        return Model({}, [50.0] * (GRADES - 1))
    n, k = len(texts), int(toxic.sum())
    least = min(MIN_ROWS, max(2, k // 2))
    names, all_rows = np.unique(np.concatenate(texts), return_counts=True)
    names, all_rows = names[all_rows >= least], all_rows[all_rows >= least]
    if not len(names):
        return Model({}, [50.0] * (GRADES - 1))
    known = []
    for t in texts:  # text by text, so only what is kept is held twice
        at = np.minimum(np.searchsorted(names, t), len(names) - 1)
        known.append(at[names[at] == t].astype(np.int32))
    of = np.repeat(np.arange(n), [len(x) for x in known])
    place = np.concatenate(known)
    hits = np.bincount(place, weights=toxic[of], minlength=len(names))
    share = all_rows / n
    z = (hits / k - (all_rows - hits) / (n - k)) / np.sqrt(share * (1 - share) * (1 / k + 1 / (n - k)) + 1e-12)
    chosen = np.flatnonzero(np.abs(z) >= MIN_Z)
    index = np.full(len(names), -1)
    index[chosen] = np.arange(len(chosen))
    kept = index[place] >= 0
    ends = np.cumsum(np.bincount(of[kept], minlength=len(texts)))
    rows = np.split(index[place][kept], ends[:-1])
    w, b = fit_ordinal(rows, toxic.astype(int), len(chosen), 2)
    score = np.array([w[r].sum() for r in rows])
    cut = np.quantile(score[toxic], [1 / 3, 2 / 3])
    grades = np.where(toxic, 1 + np.searchsorted(cut, score, "right"), 0)
    w, b = fit_ordinal(rows, grades, len(chosen), GRADES)
    return Model(dict(zip(names[chosen].tolist(), w.tolist())), b.tolist())


def train(documents: DataFrame, labels: DataFrame, text: str = "text", id_col: str = "doc_id", fit_rows: int = FIT_ROWS) -> Model:
    """The model, fitted in one task on the features of fit_rows documents at most; only the model comes to the driver."""
    known = labels.select(col("doc_id").alias("i"), col("toxic").alias("y")).where("i is not null and y is not null").groupBy("i").agg(F.max("y").alias("y"))
    sample = known.orderBy(F.xxhash64("i"), "i").limit(fit_rows)
    rows = documents.select(col(id_col).alias("i"), col(text).alias("t")).join(F.broadcast(sample), "i")

    def make():
        memo = _Memo()

        def f(ids, ys, texts):
            found = [text_features(t, memo) for t in texts]
            return [ids, ys, [np.fromiter(x, np.uint32, len(x)).tobytes() for x in found]]

        return f

    def one(batches):
        import pyarrow as pa

        got = sorted(x for b in batches for x in zip(*[c.to_pylist() for c in b.columns]))
        model = fit([np.frombuffer(f, np.uint32) for _, _, f in got], np.array([y for _, y, _ in got], bool))
        yield pa.RecordBatch.from_arrays([pa.array([list(model.weights)], pa.list_(pa.int64())), pa.array([list(model.weights.values())], pa.list_(pa.float64())), pa.array([model.cuts], pa.list_(pa.float64()))], names=["features", "weights", "cuts"])

    got = map_rows(rows, [F.col("i").cast("long"), (F.col("y") > 0), F.col("t")], make, "i long, y boolean, f binary")
    each = got.groupBy("i").agg(F.max("y").alias("y"), F.max("f").alias("f"))  # rows that repeat an id count once
    made = map_batches(each.repartition(1), one, "features array<long>, weights array<double>, cuts array<double>", __name__).first()
    return Model(dict(zip(made["features"], made["weights"])), made["cuts"]) if made else Model({}, [50.0] * (GRADES - 1))


def score(documents: DataFrame, model: Model, text: str = "text", id_col: str = "doc_id") -> DataFrame:
    """id, severity, p_toxic, toxic, grade per row."""
    def make():
        memo = _Memo(model.place)

        def f(ids, texts):
            s, p = model.severity(texts, memo)
            return [ids, np.round(s, 9), np.round(p, 9), p >= 0.5, (s + 0.5).astype(np.int32)]

        return f

    return map_rows(documents, [col(id_col).cast("long"), col(text)], make, "id long, severity double, p_toxic double, toxic boolean, grade int").withColumnRenamed("id", id_col)


def non_toxic(documents: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """The rows that the model does not reject, with all their columns; no shuffle."""
    at = documents.columns.index(text)

    def run(batches):
        import pyarrow as pa

        memo = _Memo(model.place)
        for whole in batches:
            for k in range(0, whole.num_rows, 512):
                b = whole.slice(k, 512)
                yield b.filter(pa.array(model.severity(b.column(at).to_pylist(), memo)[1] < 0.5, pa.bool_()))

    return map_whole(documents, run)


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    return score(docs, train(docs, read(spark, sf_dir, "labels")))


QUERIES = {"op2_toxicity": op2_toxicity}
ORACLES: dict[str, str] = {}
