"""Personal data by base rules and bootstrapped contextual extraction.

Base rules find e-mail and IP addresses, card and phone numbers. Those seeds
induce lexical patterns (the word before, the two words before, the words on
both sides, the characters a span is glued to); everything else that has a
kind's shape is an unknown instance: tokens of three digits or more and their
parts, numbers in groups, addresses with @ or a written-out at, IPv6. On the
graph of patterns and distinct instances Spark iterates until nothing changes:
a pattern's confidence for a kind is the confidence mass of the places where it stands at
that kind's instances, over all places where it stands in the corpus (for words: before
or around anything at all; for glued characters: before an instance),
an unknown instance's is 1 minus the product of (1 - confidence) over its
trusted patterns. Patterns of confidence ``MIN_CONFIDENCE`` and MIN_SEEDS
distinct seeds or discovered instances are trusted, and mark unknown instances
as spans of their kind; of nested ones the outer stays. Base spans are never removed.

A trusted pattern needs MIN_SEEDS at every input size. All trusted patterns
stay in a written table; they go to the executors as hashes in blocks of about
``BLOCK``, and documents are scanned once a block, so nothing unbounded is broadcast.

Edge cases: null and empty texts have no spans; of tokens of ``MAX_TOKEN``
characters and more only the parts are instances; repeated rows are read each, but
an instance counts once a pattern; positions are code points, ends exclusive.
"""

from __future__ import annotations

import hashlib
import re
from collections import Counter
from collections.abc import Iterator, Mapping
from itertools import chain

import numpy as np
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ._common import col, drop, map_batches, map_rows, map_whole, read, written
from .words import mix, word_hashes

KINDS = ("email", "ip", "card", "phone")
MIN_CONFIDENCE, MIN_SEEDS, MAX_TOKEN = 0.8, 3, 100
#: Patterns of a broadcast (9 bytes each).
BLOCK = 1 << 21

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]+)+")
# A match that fails from the first digit of a run fails from its other digits too, and one that holds ends with the run.
_IP = re.compile(r"(?<![0-9])[0-9]++\.([0-9]++)\.([0-9]++)\.([0-9]++)")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_AT = re.compile(r"[@\uff20]|\s?[(\[{<]\s?(?:at|@)\s?[)\]}>]\s?|\sat\s", re.I)
_HOST = re.compile(r"[A-Za-z0-9-]++(?:(?:\.|\s?[(\[{<]\s?(?:dot|\.)\s?[)\]}>]\s?|\sdot\s)[A-Za-z0-9-]+)*", re.I)
_IP6 = re.compile(r"(?<![0-9A-Za-z:])(?:[0-9A-Fa-f]{0,4}:){2,7}[0-9A-Fa-f]{0,4}(?![0-9A-Za-z:])")
_GROUPS = re.compile(r"(?<![0-9A-Za-z])\(?[0-9]++(?:[ ().-]{1,2}[0-9]++)+")
_PARTS = re.compile(r"(?:[0-9A-Fa-f]{0,4}:){2,7}[0-9A-Fa-f]{0,4}|[A-Za-z0-9._%+()-]+")
_NUMBERS = re.compile(r"\+?\(?[0-9][0-9().-]*")
_DIGIT = re.compile("[0-9]")
_NOT_DIGIT = re.compile("[^0-9]")


def _emails(text: str):
    """Around each @: the run of local characters before it and the domain behind it; linear in the text."""
    at, done = text.find("@"), 0
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        m = _DOMAIN.match(text, at + 1) if start < at else None
        if m:
            yield start, m.end()
            done = m.end()
        at = text.find("@", max(done, at + 1))


def _small(part: str) -> bool:
    return len(p := part.lstrip("0")) < 3 or len(p) == 3 and int(p) <= 255


def _luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        total += d if i % 2 == 0 else (2 * d - 9 if d > 4 else 2 * d)
    return total % 10 == 0


def base_spans(text: str | None) -> list[tuple[int, int, int]]:
    """(kind number, start, end) by kind, then start."""
    out: list[tuple[int, int, int]] = []
    if not text:
        return out
    out += [(0, s, e) for s, e in _emails(text)]
    if not _DIGIT.search(text):
        return out
    out += [(1, m.start(), m.end()) for m in _IP.finditer(text) if all(map(_small, m[0].split(".")))]
    for m in _CARD.finditer(text):
        if 16 <= m.end() - m.start() <= 40 and 16 <= len(d := _NOT_DIGIT.sub("", m[0])) <= 19 and _luhn(d):
            out.append((2, m.start(), m.end()))
    if "+" in text:
        out += [(3, m.start(), m.end()) for m in _PHONE.finditer(text) if 8 <= len(_NOT_DIGIT.sub("", m[0])) <= 15]
    return out


def _addresses(text: str) -> Iterator[tuple[int, int]]:
    """Around each @ or written-out at: the local characters before it and the host behind it; a bare word at needs a dot in the host."""
    for m in _AT.finditer(text):
        host = _HOST.match(text, m.end())
        if host is None or m[0].strip().lower() == "at" and not re.search(r"\.|\sdot\s", host[0], re.I):
            continue
        start = m.start()
        while start > 0 and text[start - 1] in _LOCAL and m.start() - start < MAX_TOKEN:
            start -= 1
        if start < m.start():
            yield start, host.end()


def _trimmed(text: str, start: int, end: int) -> tuple[int, int]:
    token = text[start:end]
    start += len(token) - len(token.lstrip("\"'([{<"))
    return start, start + len(token.lstrip("\"'([{<").rstrip("\"')]}>.,;:!?"))


def _tokens(text: str) -> Iterator[tuple[int, int]]:
    """Tokens with a digit, and their parts between characters that no identifier has; tokens of MAX_TOKEN characters and more as parts only."""
    pos = 0
    while m := _DIGIT.search(text, pos):
        start, end = m.start(), m.end()
        while start > pos and not text[start - 1].isspace():
            start -= 1
        while end < len(text) and not text[end].isspace():
            end += 1
        pos = end
        if end - start < MAX_TOKEN:
            yield _trimmed(text, start, end)
        for part in _PARTS.finditer(text, start, end):
            if part.end() - part.start() < MAX_TOKEN:
                yield _trimmed(text, part.start(), part.end())
            else:
                yield from (_trimmed(text, n.start(), n.end()) for n in _NUMBERS.finditer(text, part.start(), part.end()) if n.end() - n.start() < MAX_TOKEN)


def _digits(text: str) -> int:
    return sum(c.isdigit() for c in text)


def unknown_tokens(text: str, spans: list[tuple[int, int, int]]) -> list[tuple[int, int]]:
    """(start, end) of what has a kind's shape and touches no base span; of those with the same start the longest."""
    found = list(_addresses(text))
    if _DIGIT.search(text):
        found += [(s, e) for s, e in _tokens(text) if e - s >= 3 and _digits(text[s:e]) >= 3]
        found += [(m.start() + (m[0][0] == "(" and ")" not in m[0]), m.end()) for m in _GROUPS.finditer(text) if 7 <= _digits(m[0]) <= 19]
    if "::" in text or text.count(":") >= 7:
        found += [m.span() for m in _IP6.finditer(text) if len(m[0].strip(":")) > 0 and ("::" in m[0] or m[0].count(":") == 7)]
    taken = sorted((s, e) for _, s, e in spans)
    longest, k = {}, 0
    for s, e in sorted(found):
        while k < len(taken) and taken[k][1] <= s:
            k += 1
        if not any(a < e and s < b for a, b in taken[k : k + 4]):
            longest[s] = e
    return list(longest.items())


def _can_be(token: str) -> int:
    """Bits of the kinds whose shape the token has."""
    if _digits(token) >= 3:
        return 15
    return 1 if _AT.search(token) else 2


def patterns(text: str, start: int, end: int) -> list[str]:
    """Lexical contexts of a span."""
    left = [w.lower().strip("\"'([{<>}]).,;!?") for w in text[max(0, start - 80) : start].split()[-2:]]
    right = [w.lower().strip("\"'([{<>}]).,;!?") for w in text[end : end + 60].split()[:1]]
    out = []
    if start and not text[start - 1].isspace():
        out += [f"g3 {text[max(0, start - 3) : start].lower()}", f"g6 {text[max(0, start - 6) : start].lower()}"]
    if left and left[-1]:
        out.append(f"l1 {left[-1]}")
        if right and right[0]:
            out.append(f"lr {left[-1]} {right[0]}")
        if len(left) == 2 and left[0]:
            out.append(f"l2 {left[0]} {left[1]}")
    return out


def edges(documents: DataFrame, text: str = "text") -> DataFrame:
    """(pattern, instance, kind, can, n) of the corpus, n places each; kind is null for unknown instances, can has the bits of the kinds they can be."""
    def make():
        def f(texts):
            found: Counter = Counter()
            for t in texts:
                if t:
                    spans = base_spans(t)
                    for k, s, e in [*spans, *((None, s, e) for s, e in unknown_tokens(t, spans))]:
                        i = xxhash.xxh3_64_intdigest(t[s:e].lower()) >> 1
                        can = _can_be(t[s:e]) if k is None else 15
                        found.update((p, i, None if k is None else KINDS[k], can) for p in patterns(t, s, e))
            return [*zip(*found), list(found.values())] if found else None

        return f

    rows = map_rows(documents, [col(text)], make, "pattern string, instance long, kind string, can int, n long")
    return rows.groupBy("pattern", "instance", "kind", "can").agg(F.sum("n").alias("n"))


#: Odd weights of the words of a context, by the kind of pattern.
_CONTEXT = {"l1": (0x9E3779B97F4A7C15,), "l2": (0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9), "lr": (0xD6E8FEB86659FD93, 0xA0761D6478BD642F)}


def _context_key(pattern: str) -> int | None:
    """The key of a pattern of words, as ``_context_keys`` finds it in texts; None for glued characters."""
    kind, _, rest = pattern.partition(" ")
    if kind not in _CONTEXT:
        return None
    h = word_hashes([rest], strip=True)[0]
    if len(h) != len(_CONTEXT[kind]):
        return None
    return int(mix(sum(x * np.uint64(w) for x, w in zip(h[:, None], _CONTEXT[kind])))[0].view(np.int64))


def _context_keys(h: np.ndarray) -> np.ndarray:
    """Keys of all places of all kinds of word patterns in a text of these word hashes."""
    w = {k: [np.uint64(x) for x in v] for k, v in _CONTEXT.items()}
    return np.concatenate([mix(h * w["l1"][0]), mix(h[:-1] * w["l2"][0] + h[1:] * w["l2"][1]), mix(h[:-2] * w["lr"][0] + h[2:] * w["lr"][1])]).view(np.int64)


def places(documents: DataFrame, wanted: DataFrame, text: str, most: int) -> DataFrame:
    """(pattern, places) of the word patterns of the table ``wanted``: where their words stand in all texts. Documents are scanned once a block of patterns."""
    sc = documents.sparkSession.sparkContext
    keyed = written(map_rows(wanted, [F.col("pattern")], lambda: lambda names: [names, [_context_key(p) for p in names]], "pattern string, key long").where("key is not null"), "pii-contexts")

    def count(block: np.ndarray) -> DataFrame:
        shared = sc.broadcast(np.unique(block))

        def make():
            keys = shared.value
            seen = np.zeros(len(keys), np.int64)
            maybe = np.zeros(1 << 22, bool)
            maybe[(keys.view(np.uint64) >> np.uint64(42)).astype(np.int64)] = True

            def f(texts):
                for h in word_hashes(texts, strip=True):
                    k = _context_keys(h)
                    k = k[maybe[(k.view(np.uint64) >> np.uint64(42)).astype(np.int64)]]
                    at = np.minimum(np.searchsorted(keys, k), len(keys) - 1)
                    np.add.at(seen, at[keys[at] == k], 1)
                return None

            f.end = lambda: [keys[seen > 0], seen[seen > 0]] if seen.any() else None
            return f

        got = written(map_rows(documents, [col(text)], make, "key long, places long").groupBy("key").agg(F.sum("places").alias("places")), "pii-places")
        shared.destroy()
        return got

    counts, held, size = None, [], 0
    packed = map_rows(keyed, [F.col("key")], lambda: lambda keys: [[np.array(keys, np.int64).tobytes()]], "keys binary", min(most, 1 << 14))
    for raw in chain((r["keys"] for r in packed.toLocalIterator()), [None]):
        if raw is not None:
            held.append(np.frombuffer(raw, np.int64))
            size += len(held[-1])
        if held and (raw is None or size >= most):
            got = count(np.concatenate(held))
            counts = got if counts is None else counts.unionByName(got)
            held, size = [], 0
    none = wanted.sparkSession.createDataFrame([], "pattern string, places long")
    return none if counts is None else keyed.join(counts, "key").select("pattern", "places")


def _hash(pattern: str) -> int:
    return xxhash.xxh3_64_intdigest(pattern) >> 1


class Trusted(Mapping):
    """Trusted patterns and their kinds in a written table of any size."""

    def __init__(self, table: DataFrame):
        self.table = table

    def __getitem__(self, pattern: str) -> str:
        r = self.table.where(F.col("pattern") == F.lit(pattern)).first()
        if r is None:
            raise KeyError(pattern)
        return r["kind"]

    def __iter__(self) -> Iterator[str]:
        return (r["pattern"] for r in self.table.toLocalIterator())

    def __len__(self) -> int:
        return self.table.count()


def _blocks(trusted: Mapping[str, str], most: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(sorted hashes, numbers of kinds from 1) of about ``most`` patterns, streamed to the driver a block at a time; one block at least."""
    def make():
        def f(names, kinds):
            return [[np.array([_hash(p) for p in names], np.int64).tobytes()], [bytes(KINDS.index(k) + 1 for k in kinds)]]

        return f

    def parts():
        if isinstance(trusted, Trusted):
            rows = map_rows(trusted.table, [F.col("pattern"), F.col("kind")], make, "hashes binary, kinds binary", min(most, 1 << 14))
            yield from ((r["hashes"], r["kinds"]) for r in rows.toLocalIterator())
        elif trusted:
            yield tuple(x[0] for x in make()(list(trusted), list(trusted.values())))

    def block():
        h, k = np.frombuffer(b"".join(x for x, _ in held), np.int64), np.frombuffer(b"".join(x for _, x in held), np.uint8)
        order = np.argsort(h)
        return h[order], k[order]

    held, size, some = [], 0, False
    for part in parts():
        held.append(part)
        size += len(part[1])
        if size >= most:
            yield block()
            held, size, some = [], 0, True
    if held or not some:
        yield block()


def bootstrap(documents: DataFrame, text: str = "text", most: int = BLOCK) -> Trusted:
    """All trusted patterns and their kinds. ``most``: patterns of a broadcast."""
    graph = written(edges(documents, text), "pii-graph")
    seeds, unknown = graph.where("kind is not null"), graph.where("kind is null")
    bit = {k: 1 << i for i, k in enumerate(KINDS)}
    of_kind = lambda values: F.coalesce(*[F.when(F.col("kind") == k, v) for k, v in values.items()])
    # only patterns with enough instances of any kind can ever be trusted
    able = written(graph.groupBy("pattern").agg(F.count("*").alias("instances"), *[F.sum(F.when(F.col("can").bitwiseAND(b) > 0, F.col("n")).otherwise(0)).alias(k) for k, b in bit.items()]).where(F.col("instances") >= MIN_SEEDS), "pii-able")
    stands = places(documents, able.select("pattern"), text, most)
    total = written(able.join(stands, "pattern", "left").select("pattern", *[F.greatest(F.col(k), F.coalesce("places", F.lit(0))).alias(k) for k in KINDS]), "pii-totals")
    support = written(seeds.groupBy("pattern", "kind").agg(F.sum("n").cast("double").alias("mass"), F.count("*").alias("seeds")), "pii-seeds")
    trusted = found = None
    before = (-1, -1, -1.0)
    while True:
        mass = support
        if found is not None:  # unknown instances that trusted patterns of the last round hold
            more = unknown.select("pattern", "instance", "n").join(found, "instance").groupBy("pattern", "kind").agg(F.sum(F.col("confidence") * F.col("n")).alias("mass"), F.sum((F.col("confidence") >= MIN_CONFIDENCE).cast("long")).alias("seeds"))
            mass = mass.unionByName(more).groupBy("pattern", "kind").agg(F.sum("mass").alias("mass"), F.sum("seeds").alias("seeds"))
        scored = mass.where(F.col("seeds") >= MIN_SEEDS).join(total, "pattern").withColumn("confidence", F.col("mass") / of_kind({k: F.col(k) for k in KINDS}))
        new = written(scored.where(F.col("confidence") >= MIN_CONFIDENCE).select("pattern", "kind", "confidence"), "pii-patterns")
        miss = F.exp(F.sum(F.log1p(-F.least(F.col("confidence"), F.lit(0.999999)))))
        held = unknown.select("pattern", "instance", "can").join(new, "pattern").where(F.col("can").bitwiseAND(of_kind({k: F.lit(b) for k, b in bit.items()})) > 0)
        new_found = written(held.groupBy("instance", "kind").agg((1 - miss).alias("confidence")), "pii-instances")
        if found is not None:
            drop(trusted, found)
        trusted, found = new, new_found
        n, x = trusted.agg(F.count("*"), F.coalesce(F.sum("confidence"), F.lit(0.0))).first()
        now = (n, found.count(), x)
        # Both tables and all confidences only grow, and are bounded, so this ends.
        if now[:2] == before[:2] and x - before[2] <= 1e-6:
            break
        before = now
    best = Window.partitionBy("pattern").orderBy(F.desc("confidence"), "kind")
    kept = written(trusted.withColumn("r", F.row_number().over(best)).where("r = 1").select("pattern", "kind"), "pii-trusted")
    drop(graph, able, total, support, trusted, found)
    return Trusted(kept)


def candidates(text: str | None) -> tuple[list, list]:
    """(base spans, [(start, end, kinds it can be, patterns, the most telling one first)] of the unknown tokens)."""
    base = base_spans(text)
    if not text:
        return base, []
    return base, [(s, e, _can_be(text[s:e]), patterns(text, s, e)[::-1]) for s, e in unknown_tokens(text, base)]


def _added(unknown: list, marks: bytes) -> list[tuple[int, int, int]]:
    """Spans of the unknown tokens with a trusted pattern; ``marks`` has the number of the kind from 1, or 0, of every pattern in order."""
    out, at, done = [], 0, 0
    for s, e, can, names in unknown:  # by start
        kind = next((m for m in marks[at : at + len(names)] if m and can >> m - 1 & 1), 0)
        if kind and e > done:
            out.append((kind - 1, s, e))
            done = e
        at += len(names)
    return sorted(out)


def all_spans(text: str | None, trusted: Mapping[str, str]) -> tuple[list, list]:
    """(base spans, added spans), each (kind number, start, end) in order."""
    base, unknown = candidates(text)
    return base, _added(unknown, bytes(KINDS.index(k) + 1 if (k := trusted.get(p)) else 0 for *_, names in unknown for p in names))


def _look_up(block: tuple[np.ndarray, np.ndarray], found: list, marks: list) -> list[bytes]:
    """Marks of each text's patterns: those of the blocks before, and this block's."""
    counts = [sum(len(names) for *_, names in unknown) for _, unknown in found]
    h = np.fromiter((_hash(p) for _, unknown in found for *_, names in unknown for p in names), np.int64, sum(counts))
    hashes, kinds = block
    out = np.zeros(len(h), np.uint8)
    if len(hashes):
        at = np.minimum(np.searchsorted(hashes, h), len(hashes) - 1)
        out = np.where(hashes[at] == h, kinds[at], 0).astype(np.uint8)
    before = b"".join(m if m is not None else bytes(n) for m, n in zip(marks, counts))
    flat = (out | np.frombuffer(before, np.uint8)).tobytes()
    ends = np.cumsum([0, *counts]).tolist()
    return [flat[a:b] for a, b in zip(ends, ends[1:])]


def _marked(documents: DataFrame, trusted: Mapping[str, str], at: int, most: int):
    """documents with a last column of marks by all blocks but the last one, and that one as a broadcast; at: place of the text."""
    import pyarrow as pa

    sc = documents.sparkSession.sparkContext
    out = documents.toDF(*[f"c{i}" for i in range(len(documents.columns))]).withColumn("marks", F.lit(None).cast("binary"))
    shared = None
    for block in _blocks(trusted, most):
        if shared is not None:

            def run(batches, shared=shared):
                for b in (whole.slice(k, 512) for whole in batches for k in range(0, whole.num_rows, 512)):
                    found = [candidates(t) for t in b.column(at).to_pylist()]
                    new = _look_up(shared.value, found, b.column(b.num_columns - 1).to_pylist())
                    yield pa.RecordBatch.from_arrays([*b.columns[:-1], pa.array(new, b.schema.field(b.num_columns - 1).type)], schema=b.schema)

            out = map_whole(out, run)
        shared = sc.broadcast(block)
    return out, shared


def _said(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for k, s, e in spans)


def extract(documents: DataFrame, trusted: Mapping[str, str], text: str = "text", id_col: str = "doc_id", most: int = BLOCK) -> DataFrame:
    """id, counts of the base kinds, digest of the base spans, all spans, the number added and the number of all."""
    rows, shared = _marked(documents.select(col(id_col).cast("long"), col(text)), trusted, 1, most)

    def make():
        known = shared.value

        def f(ids, texts, marks):
            rows, found = [], [candidates(t) for t in texts]
            for i, (base, unknown), m in zip(ids, found, _look_up(known, found, marks)):
                added = _added(unknown, m)
                n = [sum(k == j for k, _, _ in base) for j in range(4)]
                rows.append((i, *n, hashlib.sha256(_said(base).encode()).hexdigest(), _said(sorted(base + added)), len(added), len(base) + len(added)))
            return list(zip(*rows))

        return f

    return map_rows(rows, [col(c) for c in rows.columns], make, "id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string, n_added long, n_spans long").withColumnRenamed("id", id_col)


def redacted(text: str | None, trusted: Mapping[str, str]) -> str | None:
    """Spans become [KIND]; overlapping spans become one under the first one's kind."""
    return _without(text, *all_spans(text, trusted)) if text else text


def _without(text: str | None, base: list, added: list) -> str | None:
    if not base and not added:
        return text
    out, done = [], 0
    for s, e, k in sorted((s, e, k) for k, s, e in base + added):
        if s >= done:
            out += [text[done:s], f"[{KINDS[k].upper()}]"]
        done = max(done, e)
    return "".join([*out, text[done:]])


def redact(documents: DataFrame, trusted: Mapping[str, str], text: str = "text", length: str = "n_chars", most: int = BLOCK) -> DataFrame:
    """All rows and columns, with redacted texts; an integer column ``length`` follows the new text. No shuffle."""
    names = documents.columns
    at, n_at = names.index(text), names.index(length) if length in names else None
    rows, shared = _marked(documents, trusted, at, most)
    plain = rows.drop("marks").schema

    def run(batches):
        import pyarrow as pa

        known = shared.value
        for b in (whole.slice(k, 512) for whole in batches for k in range(0, whole.num_rows, 512)):
            texts = b.column(at).to_pylist()
            found = [candidates(t) for t in texts]
            marks = _look_up(known, found, b.column(b.num_columns - 1).to_pylist())
            new = [_without(t, base, _added(unknown, m)) for t, (base, unknown), m in zip(texts, found, marks)]
            columns = list(b.columns[:-1])
            columns[at] = pa.array(new, b.schema.field(at).type)
            if n_at is not None:
                columns[n_at] = pa.array([None if t is None else len(t) for t in new], b.schema.field(n_at).type)
            yield pa.RecordBatch.from_arrays(columns, schema=pa.schema(list(b.schema)[:-1]))

    return map_batches(rows, run, plain).toDF(*names)


def op7_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    return extract(docs, bootstrap(docs))


QUERIES = {"op7_pii": op7_pii}
ORACLES: dict[str, str] = {}
