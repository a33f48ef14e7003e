"""Similarity join on word n-grams by rare-first prefix filtering.

Two documents link when 100 |A n B| >= t |A u B| on their sets of distinct k-word
shingles. The exact filters of the join:

* equal sets are one class; only classes are compared;
* rare-first prefixes: shingles are ordered by their exact number of holders, so the
  shingles that a set has alone come first and never meet another set; two sets that
  link share a shingle within their first n - ceil(t n / 100) + 1 places;
* length filter: sizes fall in buckets of ratio t / 100 and only equal or
  neighbouring buckets meet; the smaller size is at least t % of the larger;
* positional filter: at the first shared shingle of two sets nothing before it is
  shared, so what either set has from there on must reach the overlap that the sizes
  ask for;
* suffix filter: what may differ behind that shingle is what the sizes allow less all
  that stands before it on both sides. The suffixes are dealt into 256 parts by hash,
  and parts whose numbers of shingles differ in parity differ by one shingle at least;
* each surviving pair is verified once, on the full sets.

Counting moves seven bytes a shingle: a task deals its sets' shingles into buckets
of the hash space (their number follows the input), a bucket sends back only shingles
with several holders, and each set's place numbers come from its number of shingles
that were not sent back. Shingles whose share in a sketch of 2^18 counters is far
above the mean are not gathered: they count as more frequent than all others and are
ordered by hash. Keys are cut to 40 bits within a bucket; keys that meet by chance
only make more candidates.

Groups of many near copies would make the square of their size in pairs, though
their members are one component after few of them. So links are sought in
rounds: in a round every posting meets its key's centre only, pairs that verify join
components, and postings within one component are done. Rounds go on while they join a good part of what is
open; then all remaining pairs of different components are verified. Only pairs inside
one component stay unverified, so components are exact: no link between components
is lost. ``links`` verifies all pairs of classes instead, without components.

``documents`` is a stored table: it is read several times, and a task that is run
again must see the same rows in the same order.

Edge cases: null and empty texts have an empty set and link with nothing; fewer
than k words make one shingle; a null id takes part in nothing and has a null
component; rows that repeat an id are one document.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from entityflow.operators.components import connected_components

from ._common import col, drop, map_batches, map_rows, read, written
from .words import shingles, word_hashes

#: Counters of the sketch that finds keys too frequent to gather in one task, and how far above the mean these are.
SKETCH_BITS, PARTS, HOT, HOT_MEANS = 18, 16, 2000, 8
#: Shingles that a task deals at once (with 65,535 sets at most), and that a task counts.
FLUSH, BUCKET = 1 << 21, 1 << 21
#: A round with centres is followed by another while it joins this share of the open classes; all rounds at most.
WORTH, ROUNDS = 0.05, 8
#: Signatures a task remembers to emit equal sets once.
SEEN = 50_000
#: Parities of a suffix in 256 parts.
MARKS = ("p0", "p1", "p2", "p3")
#: A count that stands for a key of the sketch's hot counters, above all exact ones.
TOP = 65_535


def _signature(sets: np.ndarray) -> tuple[int, int]:
    d = xxhash.xxh3_128_intdigest(sets.tobytes())
    return (d >> 65), (d & ((1 << 63) - 1))


CLASSES = "id long, n long, s1 long, s2 long, part int, counts binary"


def classes(documents: DataFrame, k: int, text: str, id_col: str) -> DataFrame:
    """(id, n, s1, s2) per row: size of the set and its 126-bit signature (null for empty sets). Rows with a part
    number hold a task's counters of the sketch instead."""
    def make():
        total = np.zeros(1 << SKETCH_BITS, np.int64)
        none = [None] * 4

        def f(ids, texts):
            rows, found = [], []
            for i, w in zip(ids, word_hashes(texts)):
                s = shingles(w, k)
                rows.append((i, len(s), *(_signature(s) if len(s) else (None, None)), None, None))
                found.append(s)
            at = np.concatenate(found) >> np.uint64(64 - SKETCH_BITS)
            np.add(total, np.bincount(at.astype(np.int64), minlength=len(total)), out=total)
            return list(zip(*rows)) if rows else None

        def end():
            rows = [(*none, part, _small(x)) for part, x in enumerate(total.reshape(PARTS, -1)) if x.any()]
            return list(zip(*rows)) or None

        f.end = end
        return f

    return map_rows(documents, [col(id_col).cast("long"), col(text)], make, CLASSES)


def _small(x: np.ndarray) -> bytes:
    """Counters in two or eight bytes, whichever they need; the first byte says which."""
    kind = "<u2" if x.max() < 1 << 16 else "<i8"
    return kind[2].encode() + x.astype(kind).tobytes()


def _add(batches):
    """Sums of the tables of each part."""
    total: dict[int, np.ndarray] = {}
    for b in batches:
        for part, raw in zip(*[c.to_pylist() for c in b.columns]):
            x = np.frombuffer(raw, f"<{'u' if raw[:1] == b'2' else 'i'}{raw[:1].decode()}", offset=1).astype(np.int64)
            total[part] = total[part] + x if part in total else x
    if total:
        yield pa.RecordBatch.from_arrays([pa.array(list(total), pa.int32()), pa.array([_small(x) for x in total.values()], pa.binary())], names=["part", "counts"])


def _hot(rows: DataFrame) -> tuple[np.ndarray, int]:
    """Which counters of the sketch are hot, and the number of shingles of all rows. Parts of the table are summed on the cluster, in two levels."""
    schema = "part int, counts binary"
    salted = rows.where("part is not null").select("part", "counts").withColumn("salt", F.pmod(F.xxhash64("counts"), F.lit(16))).repartition("part", "salt").drop("salt")
    total = np.zeros((PARTS, (1 << SKETCH_BITS) // PARTS), np.int64)
    for r in map_batches(map_batches(salted, _add, schema).repartition("part"), _add, schema).toLocalIterator():  # a table of fixed size
        total[r["part"]] = np.frombuffer(r["counts"], f"<{'u' if r['counts'][:1] == b'2' else 'i'}{r['counts'][:1].decode()}", offset=1)
    total = total.ravel()
    return total > HOT + HOT_MEANS * total.sum() / len(total), int(total.sum())


DEALT = "bucket int, kind int, flush long, data binary"
#: Kinds of dealt rows: keys to count, keys that several sets hold (with counts), a flush's sets.
KEYS, SHARED, SETS = 0, 1, 2


def _dealt(documents: DataFrame, k: int, hot, buckets: int, text: str, id_col: str) -> DataFrame:
    """The shingles of all sets by bucket, packed: five bytes of the key, two of the set's number in its flush."""
    def make():
        is_hot = hot.value
        shift = np.uint64(64 - SKETCH_BITS)
        task = TaskContext.get().partitionId()
        seen: set = set()
        held: list = []
        state = [0, 0]  # shingles held, flushes made

        def flush():
            if not held:
                return None
            n = np.array([len(s) for s, _ in held])
            key = np.concatenate([s for s, _ in held])
            of = np.repeat(np.arange(len(held), dtype=np.uint16), n)
            at = ((key >> np.uint64(32)) * np.uint64(buckets)) >> np.uint64(32)
            at = at.astype(np.uint16) if buckets <= 1 << 16 else at.astype(np.int64)
            order = np.argsort(at, kind="stable")
            key, of, at = key[order], of[order], at[order]
            often = is_hot[(key >> shift).astype(np.int64)]
            cuts = np.flatnonzero(np.append(True, at[1:] != at[:-1]))
            name = task << 32 | state[1]
            rows = [(int(at[0]), SETS, name, np.array([s1 for _, s1 in held], np.int64).tobytes() + n.astype(np.int32).tobytes())]
            for a, b in zip(cuts.tolist(), [*cuts[1:].tolist(), len(key)]):
                h = often[a:b]
                if h.any():
                    rows.append((int(at[a]), SHARED, name, _pack(key[a:b][h], of[a:b][h], np.full(int(h.sum()), TOP, np.uint16))))
                    h = ~h
                    if h.any():
                        rows.append((int(at[a]), KEYS, name, _pack(key[a:b][h], of[a:b][h])))
                else:
                    rows.append((int(at[a]), KEYS, name, _pack(key[a:b], of[a:b])))
            held.clear()
            state[0] = 0
            state[1] += 1
            return list(zip(*rows))

        def f(ids, texts):
            for i, w in zip(ids, word_hashes(texts)):
                s = shingles(w, k) if i is not None else ()
                if not len(s):
                    continue
                sig = _signature(s)
                if sig in seen:
                    continue
                if len(seen) < SEEN:
                    seen.add(sig)
                held.append((s, sig[0]))
                state[0] += len(s)
            return flush() if state[0] >= FLUSH or len(held) > 65_000 else None

        f.end = flush
        return f

    return map_rows(documents, [col(id_col).cast("long"), col(text)], make, DEALT)


def _pack(key: np.ndarray, of: np.ndarray, counts: np.ndarray | None = None) -> bytes:
    low = np.ascontiguousarray(key.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :5])
    return low.tobytes() + of.tobytes() + (b"" if counts is None else counts.tobytes())


def _unpack(raw: bytes, wide: int) -> tuple[np.ndarray, ...]:
    """Keys (40 bits), set numbers and, for wide rows, counts."""
    n = len(raw) // wide
    key = np.zeros((n, 8), np.uint8)
    key[:, :5] = np.frombuffer(raw, np.uint8, 5 * n).reshape(n, 5)
    return key.view("<u8").ravel(), *[np.frombuffer(raw, np.uint16, n, a) for a in range(5 * n, len(raw), 2 * n or 1)]


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


def _count(batches):
    """One bucket at a time: the keys that several sets hold go back to their flushes with their counts."""
    for bucket, rows in _groups(batches, 0):
        out = [r for r in rows if r[1] != KEYS]
        rows = [r for r in rows if r[1] == KEYS]
        if rows:
            key, of = (np.concatenate(x) for x in zip(*[_unpack(r[3], 7) for r in rows]))
            order = np.argsort(key, kind="stable")
            k = key[order]
            starts = np.flatnonzero(np.append(True, k[1:] != k[:-1]))
            c = np.diff(np.append(starts, len(k)))
            count = np.empty(len(k), np.uint16)
            count[order] = np.repeat(np.minimum(c, TOP - 1), c)
            ends = np.cumsum([len(r[3]) // 7 for r in rows])
            for (_, _, flush, _), a, b in zip(rows, [0, *ends[:-1].tolist()], ends.tolist()):
                m = np.flatnonzero(count[a:b] > 1) + a
                if len(m):
                    out.append((bucket, SHARED, flush, _pack(key[m], of[m], count[m])))
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), (pa.int32(), pa.int32(), pa.int64(), pa.binary()))], names=["bucket", "kind", "flush", "data"])


POSTINGS = "key long, s1 long, n long, pos long, " + ", ".join(f"{m} long" for m in MARKS)


def _prefixes(t: int):
    """One flush at a time: the postings of each set's prefix, with the parities of what follows each."""
    def run(batches):
        for _, rows in _groups(batches, 2):
            table = next(r[3] for r in rows if r[1] == SETS)
            sets = len(table) // 12
            s1, n = np.frombuffer(table, np.int64, sets), np.frombuffer(table, np.int32, sets, 8 * sets).astype(np.int64)
            rows = [r for r in rows if r[1] == SHARED]
            if not rows:
                continue
            key, of, count = (np.concatenate(x) for x in zip(*[(k | np.uint64(r[0] << 40), o, c) for r in rows for k, o, c in [_unpack(r[3], 9)]]))
            order = np.lexsort((key, count, of))
            key, of = key[order], of[order].astype(np.int64)
            shared = np.bincount(of, minlength=sets)
            ends = np.cumsum(shared)
            pos = n[of] - ends[of] + np.arange(len(key))
            first = np.append(True, (key[1:] != key[:-1]) | (of[1:] != of[:-1]))
            size = n - (t * n + 99) // 100 + 1
            pick = np.flatnonzero(first & (pos < size[of]))
            if not len(pick):
                continue
            after = np.append(np.flatnonzero(first), len(key))  # places behind runs of keys that met in a set
            after = after[np.cumsum(first)[pick]]
            part = (key * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(56)
            columns = [key[pick].view(np.int64), s1[of[pick]], n[of[pick]], pos[pick]]
            for m in range(len(MARKS)):
                bit = np.where(part >> np.uint64(6) == m, np.uint64(1) << (part & np.uint64(63)), np.uint64(0))
                total = np.append(np.uint64(0), np.bitwise_xor.accumulate(bit))
                columns.append((total[ends[of[pick]]] ^ total[after]).view(np.int64))
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["key", "s1", "n", "pos", *MARKS])

    return run


def postings(documents: DataFrame, rows: DataFrame, k: int, t: int, text: str, id_col: str) -> DataFrame:
    """(key, s1, n, pos, parities): the shingles of every set's prefix that another set holds too; rows may repeat."""
    spark = documents.sparkSession
    hot, total = _hot(rows)
    shared = spark.sparkContext.broadcast(hot)
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-total // BUCKET))
    buckets = min(1 << 23, 4 * parts)  # several a task, so tasks are alike
    dealt = _dealt(documents, k, shared, buckets, text, id_col).repartition(parts, "bucket").sortWithinPartitions("bucket")
    back = map_batches(dealt, _count, DEALT, __name__).repartition(parts, "flush").sortWithinPartitions("flush")
    return map_batches(back, _prefixes(t), POSTINGS, __name__)


def _possible(t: int):
    """The length, positional and suffix filters of a posting pair x, y that may be the first shared one of its sets."""
    need = F.expr(f"({t} * (x.n + y.n) + {99 + t}) div {100 + t}")  # least overlap that reaches the threshold
    length = F.expr(f"100 * least(x.n, y.n) >= {t} * greatest(x.n, y.n)")
    place = F.least(F.col("x.n") - F.col("x.pos"), F.col("y.n") - F.col("y.pos")) >= need
    odd = F.expr(" + ".join(f"bit_count(x.{m} ^ y.{m})" for m in MARKS))
    return length & place & (odd <= F.col("x.n") + F.col("y.n") - 2 * need - F.col("x.pos") - F.col("y.pos"))


def shingle_sets(documents: DataFrame, k: int, wanted: DataFrame, text: str, id_col: str) -> DataFrame:
    """(id, set) of the wanted ids. A Bloom filter sized by their number (2^30 bits at most) goes ahead of the join, so other texts are not shuffled."""
    spark = documents.sparkSession
    bits = 1 << min(30, max(20, (16 * wanted.count()).bit_length()))
    parts = map_batches(map_batches(wanted.select("id"), _bloom_parts(bits), "part int, bits binary").repartition("part"), _bloom_or, "part int, bits binary")
    bloom = bytearray(bits // 8)
    for r in parts.toLocalIterator():
        bloom[r["part"] * _PART : (r["part"] + 1) * _PART] = r["bits"]
    shared = spark.sparkContext.broadcast(bytes(bloom))

    def make():
        table = np.frombuffer(shared.value, np.uint8)

        def f(ids, texts):
            ids_ = np.array([-1 if i is None else i for i in ids], np.int64)
            ok = np.ones(len(ids_), bool)
            for h in _places(ids_, bits):
                ok &= (table[h >> 3] >> (h & 7)) & 1 == 1
            keep = [j for j in np.flatnonzero(ok).tolist() if ids[j] is not None]
            if not keep:
                return None
            sets = [shingles(w, k).view(np.int64) for w in word_hashes([texts[j] for j in keep])]
            return [[ids[j] for j in keep], pa.ListArray.from_arrays(np.append(0, np.cumsum([len(s) for s in sets])).astype(np.int32), np.concatenate(sets))]

        return f

    found = map_rows(documents, [col(id_col).cast("long"), col(text)], make, "id long, set array<long>", 64)
    return found.join(wanted.select("id").distinct(), "id", "left_semi").dropDuplicates(["id"])


_PART = 1 << 16


def _places(ids: np.ndarray, bits: int) -> list[np.ndarray]:
    u = ids.view(np.uint64)
    a = u * np.uint64(0x9E3779B97F4A7C15)
    b = (u ^ (u >> np.uint64(31))) * np.uint64(0xC2B2AE3D27D4EB4F)
    return [((x >> np.uint64(20)) % np.uint64(bits)).astype(np.int64) for x in (a, b, a ^ (b >> np.uint64(7)))]


def _bloom_parts(bits: int):
    """Set bits of a partition, by parts of the filter."""
    def run(batches):
        held: dict[int, np.ndarray] = {}
        for b in batches:
            ids = np.array(b.column(0).to_pylist(), np.int64)
            for h in _places(ids, bits):
                for p in np.unique(h // (8 * _PART)).tolist():
                    part = held.setdefault(p, np.zeros(_PART, np.uint8))
                    own = h[h // (8 * _PART) == p] - p * 8 * _PART
                    np.bitwise_or.at(part, own >> 3, (1 << (own & 7)).astype(np.uint8))
        if held:
            yield pa.RecordBatch.from_arrays([pa.array(list(held), pa.int32()), pa.array([v.tobytes() for v in held.values()], pa.binary())], names=["part", "bits"])

    return run


def _bloom_or(batches):
    held: dict[int, np.ndarray] = {}
    for b in batches:
        for p, raw in zip(*[c.to_pylist() for c in b.columns]):
            x = np.frombuffer(raw, np.uint8)
            held[p] = held[p] | x if p in held else x
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(list(held), pa.int32()), pa.array([v.tobytes() for v in held.values()], pa.binary())], names=["part", "bits"])


def linked(pairs: DataFrame, sets: DataFrame, t: int) -> DataFrame:
    """(a, b, shared, n_a, n_b) of the pairs that reach the threshold, each verified once on the full sets."""
    both = pairs.join(sets.select(F.col("id").alias("a"), F.col("set").alias("sa")), "a").join(sets.select(F.col("id").alias("b"), F.col("set").alias("sb")), "b")
    sized = both.select("a", "b", F.size(F.array_intersect("sa", "sb")).cast("long").alias("shared"), F.size("sa").cast("long").alias("n_a"), F.size("sb").cast("long").alias("n_b"))
    return sized.where(100 * F.col("shared") >= t * (F.col("n_a") + F.col("n_b") - F.col("shared")))


def _star_pairs(live: DataFrame, t: int, number: int) -> DataFrame:
    """The pairs of each posting with its key's centre that pass the filters: as many as there are postings at most.
    The first centre is the class with the fewest shingles before the key, the most like its fellows; later ones go by a seeded hash."""
    by = F.struct("pos", F.xxhash64("id")) if number == 0 else F.xxhash64("id", F.lit(number))
    centre = live.groupBy("key").agg(F.min_by(F.struct("id", "n", "pos", *MARKS, "comp"), by).alias("y")).select("key", "y.*")
    met = live.alias("x").join(centre.alias("y"), (F.col("x.key") == F.col("y.key")) & (F.col("x.comp") != F.col("y.comp")) & _possible(t))
    return met.select(F.least("x.id", "y.id").alias("a"), F.greatest("x.id", "y.id").alias("b")).distinct()


def _pairs(live: DataFrame, t: int) -> DataFrame:
    """All pairs that pass the filters: postings of one size bucket meet those of the same and the next."""
    other = live.withColumn("bucket", F.explode(F.array(F.col("bucket"), F.col("bucket") - 1)))
    apart = F.expr("x.comp <> y.comp and (y.n, y.id) > (x.n, x.id)") if "comp" in live.columns else F.expr("(y.n, y.id) > (x.n, x.id)")
    met = live.alias("x").join(other.alias("y"), (F.col("x.key") == F.col("y.key")) & (F.col("x.bucket") == F.col("y.bucket")) & apart & _possible(t))
    return met.select(F.least("x.id", "y.id").alias("a"), F.greatest("x.id", "y.id").alias("b")).distinct()


def _prepared(documents: DataFrame, k: int, t: int, text: str, id_col: str) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """Rows with their signatures, classes by signature, postings that may have a partner, and the sets behind these (the last two are written tables)."""
    made = written(classes(documents, k, text, id_col), "join-classes")
    rows = made.where("part is null").select("id", "n", "s1", "s2")
    class_of = rows.where("id is not null and s1 is not null").groupBy("s1", "s2").agg(F.min("id").alias("rep"))
    found = written(postings(documents, made, k, t, text, id_col), "join-prefixes")
    known = found.distinct().join(class_of, "s1").select("key", F.col("rep").alias("id"), "n", "pos", *MARKS)
    known = written(known, "join-postings")
    post = _with_partner(known, t)
    ids = written(post.select("id").distinct(), "join-ids")
    sets = written(shingle_sets(documents, k, ids, text, id_col), "join-sets")
    drop(found, known, ids)
    return rows, class_of, post, sets


def components(documents: DataFrame, k: int = 3, t: int = 90, text: str = "text", id_col: str = "doc_id") -> DataFrame:
    """(id, n, component) per row."""
    rows, class_of, post, sets = _prepared(documents, k, t, text, id_col)
    labels = tested = None
    made_tables = [post, sets]

    def save(df: DataFrame, name: str) -> DataFrame:
        made_tables.append(written(df, name))
        return made_tables[-1]

    for number in range(ROUNDS + 1):
        comp = F.col("id") if labels is None else F.coalesce("component", "id")
        at = post if labels is None else post.join(labels.withColumnRenamed("node", "id"), "id", "left")
        at = at.select("key", "bucket", "id", "n", "pos", *MARKS, comp.alias("comp"))
        several = at.groupBy("key").agg(F.min("comp").alias("least"), F.max("comp").alias("most")).where("least <> most").select("key")
        live = save(at.join(several, "key", "left_semi"), "join-live")
        open_ = live.select("id").distinct().count()
        if not open_:
            break
        last = number == ROUNDS or (number > 0 and joined < WORTH * open_)
        pairs = _pairs(live, t) if last else _star_pairs(live, t, number)
        if tested is not None:  # each pair is verified once
            pairs = pairs.join(tested, ["a", "b"], "left_anti")
        pairs = save(pairs, "join-pairs")
        links = save(linked(pairs, sets, t).select("a", "b"), "join-links")
        tested = pairs if tested is None else tested.unionByName(pairs)
        joined = links.count()
        if joined:
            ends = live.select("id", "comp").distinct()
            e = links.join(ends.select(F.col("id").alias("a"), F.col("comp").alias("src")), "a").join(ends.select(F.col("id").alias("b"), F.col("comp").alias("dst")), "b").select("src", "dst")
            made = connected_components(e, lambda d: save(d, "join-cc"))
            if labels is None:
                labels = made
            else:
                step = made.select(F.col("node").alias("component"), F.col("component").alias("to"))
                old = labels.join(step, "component", "left").select("node", F.coalesce("to", "component").alias("component"))
                labels = save(old.unionByName(made.join(labels.select("node"), "node", "left_anti")), "join-labels")
        if last:
            break
    drop(*[x for x in made_tables if x is not labels])
    out = rows.join(class_of, ["s1", "s2"], "left")
    if labels is not None:
        out = out.join(labels.select(F.col("node").alias("rep"), "component"), "rep", "left")
    else:
        out = out.withColumn("component", F.lit(None).cast("long"))
    # an empty set is a component of its own
    return out.select("id", "n", F.when(F.col("id").isNotNull(), F.coalesce("component", "rep", "id")).alias("component"))


def links(documents: DataFrame, k: int = 3, t: int = 90, text: str = "text", id_col: str = "doc_id") -> tuple[DataFrame, DataFrame]:
    """The whole join: (a, b, shared, n_a, n_b) of every pair of classes that link, a class named by its smallest id,
    and (id, class) of all rows with a set. Rows of one class link with each other too; they are not expanded."""
    rows, class_of, post, sets = _prepared(documents, k, t, text, id_col)
    tried = written(_pairs(post, t), "join-pairs")
    pairs = written(linked(tried, sets, t), "join-links")
    drop(post, sets, tried)
    return pairs, rows.where("id is not null").join(class_of, ["s1", "s2"]).select("id", F.col("rep").alias("class"))


def link_counts(documents: DataFrame, k: int = 3, t: int = 90, text: str = "text", id_col: str = "doc_id") -> DataFrame:
    """(id, class, links) per row with an id: its class (null for an empty set) and the number of other rows it links with."""
    pairs, member = links(documents, k, t, text, id_col)
    size = member.groupBy("class").agg(F.count("*").alias("size"))
    ends = pairs.select("a", "b").unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b")))
    far = ends.join(size.withColumnRenamed("class", "b"), "b").groupBy("a").agg(F.sum("size").alias("far"))
    per = size.join(far.withColumnRenamed("a", "class"), "class", "left").select("class", (F.col("size") - 1 + F.coalesce("far", F.lit(0))).alias("links"))
    every = documents.select(col(id_col).cast("long").alias("id")).where("id is not null")
    counted = member.join(per, "class").distinct()
    return every.join(counted, "id", "left").select("id", "class", F.coalesce("links", F.lit(0)).cast("long").alias("links"))


def _with_partner(post: DataFrame, t: int) -> DataFrame:
    """Postings whose key another class of a possible size holds: sizes fall in buckets of ratio t / 100, so a partner is in the same or the next bucket."""
    width = math.log(100 / t) * 1.000001 if t < 100 else 1e-9
    sized = post.withColumn("bucket", F.floor(F.log(F.col("n").cast("double")) / F.lit(width)).cast("long"))
    held = sized.groupBy("key", "bucket").agg(F.count("*").alias("c"))
    near = held.select("key", F.explode(F.array(F.col("bucket") - 1, F.col("bucket"), F.col("bucket") + 1)).alias("bucket"), "c").groupBy("key", "bucket").agg(F.sum("c").alias("c"))
    return written(sized.join(near.where("c > 1").select("key", "bucket"), ["key", "bucket"], "left_semi"), "join-partners")


def op6_shingle_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = components(read(spark, sf_dir, "documents"))
    return made.select(F.col("id").alias("doc_id"), F.col("n").alias("n_shingles"), F.col("component").alias("component_id"))


def one_of_each(documents: DataFrame, k: int = 5, t: int = 80, text: str = "text", id_col: str = "doc_id") -> DataFrame:
    """The rows of every component's smallest id, with all columns; rows without id or shingles stay. Rows that repeat the kept id stay."""
    made = components(documents, k, t, text, id_col)
    gone = written(made.where("id is not null and component <> id").select("id").distinct(), "join-gone")
    plain = documents.toDF(*[f"c{i}" for i in range(len(documents.columns))])
    return plain.join(gone, plain[f"c{documents.columns.index(id_col)}"] == gone["id"], "left_anti").toDF(*documents.columns)


#: The same by joining all shingles with each other: for small tables.
OP6_SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws FROM documents
), s AS (
  SELECT doc_id, CASE WHEN len(ws) = 0 THEN []::VARCHAR[] WHEN len(ws) < 3 THEN [array_to_string(ws, ' ')]
    ELSE list_distinct(list_transform(range(1, len(ws) - 1), lambda i: ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2])) END AS sh FROM w
), x AS (SELECT DISTINCT doc_id, len(sh) AS n, unnest(sh) AS k FROM s),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, a.n AS na, b.n AS nb, count(*) AS m FROM x a JOIN x b ON a.k = b.k AND a.doc_id < b.doc_id AND 100 * least(a.n, b.n) >= 90 * greatest(a.n, b.n) GROUP BY ALL),
e AS (SELECT a, b FROM p WHERE 100 * m >= 90 * (na + nb - m)),
u AS (SELECT a, b FROM e UNION ALL SELECT b, a FROM e),
r AS (SELECT doc_id AS node, doc_id AS reach FROM documents UNION SELECT r.node, u.b FROM r JOIN u ON u.a = r.reach)
SELECT s.doc_id, len(sh)::BIGINT AS n_shingles, (SELECT min(reach) FROM r WHERE r.node = s.doc_id) AS component_id FROM s
"""

QUERIES = {"op6_shingle_join": op6_shingle_join}
ORACLES = {"op6_shingle_join": OP6_SQL}
