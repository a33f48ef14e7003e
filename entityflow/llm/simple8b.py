r"""Token ids as Simple-8b words: a binary format for id sequences and its files.

A 64-bit word holds a selector in its top 4 bits and as many ids as fit in the
other 60 (240 or 120 zeros, 60 of 1 bit, ... 1 of 60 bits). Ids of 2^60 - 1 and
more are escapes: a one-id word of all ones and then the raw id. A block covers
up to ``BLOCK`` ids and has its own word offset, id count and list of escape
words in the header, so every block decodes on its own and without a loop over
words.

A file is a table of segments in ascending document order (Parquet is only the
container, so any store that Spark writes will do). A segment's payload is::

    magic "S8B1" | u32 documents, u32 blocks, u32 escapes | i64 ids, u32 lengths, u8 null flags of the documents
    u32 block id counts | u32 block word counts | u32 escape word positions | u64 words

Edge cases: null and empty texts are the end id alone; a null doc_id sorts
first; rows of equal doc_id are ordered by a hash of their texts, then by text; empty tables give no segment.
"""

from __future__ import annotations

import re
import struct
import zlib
from functools import lru_cache
from string import punctuation

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ._common import CACHES, RaggedMemo, col, map_batches, map_rows, read, written

# Fixed values of the format: ids and bits of each selector.
COUNT = np.array([240, 120, 60, 30, 20, 15, 12, 10, 8, 7, 6, 5, 4, 3, 2, 1])
BITS = np.array([0, 0, 1, 2, 3, 4, 5, 6, 7, 8, 10, 12, 15, 20, 30, 60])
ESCAPE = (1 << 60) - 1
#: Ids below 2^width need level i at most; level of every small id.
_LIMITS = np.array([1 << b for b in (0, 1, 2, 3, 4, 5, 6, 7, 8, 10, 12, 15, 20, 30)], np.uint64)
_LEVEL = np.searchsorted(_LIMITS, np.arange(1 << 16, dtype=np.uint64), "right").astype(np.uint8)
BLOCK = 1 << 15
#: Ids gathered before a segment is written.
SEGMENT = 1 << 19


def pack(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """uint64 ids of one block -> (words, positions of the raw words behind escapes)."""
    ids = np.asarray(ids, np.uint64)
    n = len(ids)
    if not n:
        return np.zeros(0, np.uint64), np.zeros(0, np.uint32)
    need = np.zeros(n + 256, np.uint8)
    need[:n] = _LEVEL[ids.astype(np.int64)] if int(ids.max()) < len(_LEVEL) else np.searchsorted(_LIMITS, ids, "right")
    widest = {1: need}  # largest need of the next 1, 2, 4 ... ids
    for k in (1, 2, 4, 8, 16, 32, 64):
        widest[2 * k] = np.maximum(widest[k][: n + 256 - 2 * k], widest[k][k : n + 256 - k])
    pick = np.full(n, 15, np.uint8)
    for sel in range(14, -1, -1):  # from few wide ids to many narrow ones; the last that fits stays
        c = int(COUNT[sel])
        k = 1 << (c.bit_length() - 1)
        w = widest[k]
        fits = np.maximum(w[:n], w[c - k : c - k + n]) <= max(0, sel - 1)  # the block's end may be filled up with zeros
        if not fits.any():
            break  # narrower selectors need longer runs of smaller ids still
        pick -= fits.view(np.uint8)  # what fits a selector fits all wider ones
    step = COUNT.astype(np.uint8)[pick].tobytes()
    starts, i = [], 0
    while i < n:
        starts.append(i)
        i += step[i]
    at = np.array(starts)
    sel = pick[at]
    words = np.zeros(len(at), np.uint64)
    padded = np.append(ids, np.zeros(240, np.uint64))
    escaped = np.flatnonzero((sel == 15) & (ids[at] >= ESCAPE))
    for s in range(2, 16):
        k = np.flatnonzero(sel == s)
        if len(k):
            values = padded[at[k][:, None] + np.arange(COUNT[s])]
            if s == 15:
                values = np.minimum(values, np.uint64(ESCAPE))
            words[k] = np.bitwise_or.reduce(values << (np.arange(COUNT[s], dtype=np.uint64) * np.uint64(BITS[s])), axis=1)
    words |= sel.astype(np.uint64) << np.uint64(60)
    raw = escaped + 1 + np.arange(len(escaped))
    return np.insert(words, escaped + 1, ids[at[escaped]]), raw.astype(np.uint32)


def unpack(words: np.ndarray, n: int, raw: np.ndarray) -> np.ndarray:
    """The n ids of one block."""
    keep = np.ones(len(words), bool)
    keep[raw] = False
    body = words[keep]
    sel = (body >> np.uint64(60)).astype(np.int64)
    count = COUNT[sel]
    ends = np.cumsum(count)
    out = np.zeros(int(ends[-1]) if len(ends) else 0, np.uint64)
    for s in range(2, 16):
        k = np.flatnonzero(sel == s)
        if len(k):
            shift = np.arange(COUNT[s], dtype=np.uint64) * np.uint64(BITS[s])
            mask = np.uint64((1 << int(BITS[s])) - 1)
            out[(ends[k] - COUNT[s])[:, None] + np.arange(COUNT[s])] = (body[k][:, None] >> shift) & mask
    if len(raw):
        at = raw.astype(np.int64) - 1 - np.arange(len(raw))
        out[ends[at] - 1] = words[raw]
    return out[:n]


def segment(doc_ids: list[int | None], rows: list[np.ndarray]) -> bytes:
    """Header, block offsets and words of consecutive documents."""
    lengths = np.array([len(r) for r in rows], "<u4")
    ids = np.concatenate(rows).astype(np.uint64) if rows else np.zeros(0, np.uint64)
    counts, sizes, raws, parts = [], [], [], []
    base = 0
    for k in range(0, len(ids), BLOCK):
        words, raw = pack(ids[k : k + BLOCK])
        counts.append(min(BLOCK, len(ids) - k))
        sizes.append(len(words))
        raws.append(raw.astype(np.int64) + base)
        base += len(words)
        parts.append(words)
    raw = np.concatenate(raws) if raws else np.zeros(0, np.int64)
    keys = np.array([0 if d is None else d for d in doc_ids], "<i8")
    nulls = np.array([d is None for d in doc_ids], "u1")
    return b"".join([b"S8B1", struct.pack("<III", len(rows), len(counts), len(raw)), keys.tobytes(), lengths.tobytes(), nulls.tobytes(), np.array(counts, "<u4").tobytes(), np.array(sizes, "<u4").tobytes(), raw.astype("<u4").tobytes(), *[p.astype("<u8").tobytes() for p in parts]])


def read_segment(data: bytes):
    """(doc ids, lengths, all ids of the segment)."""
    if data[:4] != b"S8B1":
        raise ValueError("not a Simple-8b segment")
    docs, blocks, escapes = struct.unpack_from("<III", data, 4)
    at = 16

    def take(n: int, kind: str) -> np.ndarray:
        nonlocal at
        out = np.frombuffer(data, kind, n, at)
        at += out.nbytes
        return out

    keys, lengths, nulls, counts, sizes, raw = take(docs, "<i8"), take(docs, "<u4"), take(docs, "u1"), take(blocks, "<u4"), take(blocks, "<u4"), take(escapes, "<u4").astype(np.int64)
    words = np.frombuffer(data, "<u8", -1, at)
    offsets = np.concatenate([[0], np.cumsum(sizes, dtype=np.int64)])
    parts = [unpack(words[offsets[b] : offsets[b + 1]], int(counts[b]), raw[(raw >= offsets[b]) & (raw < offsets[b + 1])] - offsets[b]) for b in range(blocks)]
    ids = np.concatenate(parts) if parts else np.zeros(0, np.uint64)
    return [None if z else k for k, z in zip(keys.tolist(), nulls.tolist())], lengths, ids


#: before: ids of the part's earlier segments.
SEGMENTS = "part int, seg int, n_docs long, n_ids long, before long, payload binary"


def write_ids(df: DataFrame, encoder, end_id: int | None, text: str = "text", id_col: str = "doc_id") -> DataFrame:
    """Encode texts and write segments in ascending id order; returns the written segment table.

    ``encoder()`` runs in the worker and returns f(list of texts) -> list of int sequences.
    Texts are range-partitioned by id before they are encoded, so nothing is encoded twice.
    """
    def run(batches):
        from pyspark import TaskContext

        code, part, seg = encoder(), TaskContext.get().partitionId(), 0
        keys: list = []
        rows: list[np.ndarray] = []
        held = before = 0

        def out():
            nonlocal seg, held, before
            row = pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), pa.array([seg], pa.int32()), pa.array([len(keys)]), pa.array([held]), pa.array([before]), pa.array([segment(keys, rows)], pa.binary())], names=["part", "seg", "n_docs", "n_ids", "before", "payload"])
            keys.clear()
            rows.clear()
            seg, held, before = seg + 1, 0, before + held
            return row

        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                ids, texts = [c.to_pylist() for c in batch.slice(at, 256).columns]
                for i, r in zip(ids, code([t or "" for t in texts])):
                    keys.append(i)
                    rows.append(r if end_id is None else np.append(r, end_id))
                    held += len(rows[-1])
                    if held >= SEGMENT:
                        yield out()
        if keys:
            yield out()

    rows = df.select(col(id_col).cast("long").alias("k"), col(text).alias("t"))
    # rows of one id (or of none) are spread by a hash of their texts
    dealt = rows.withColumn("h", F.xxhash64("t")).repartitionByRange("k", "h").sortWithinPartitions("k", "h", "t").select("k", "t")
    return written(map_batches(dealt, run, SEGMENTS), "simple8b")


def read_ids(segments: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """id, start (ids of all documents before it), n_tokens and the ids' bytes (little-endian unsigned 32 bits) per document, from the files."""
    def make():
        def f(starts, payloads):
            out: list[list] = [[], [], [], []]
            for start, data in zip(starts, payloads):
                keys, lengths, ids = read_segment(data)
                raw = memoryview(ids.astype("<u4").tobytes())
                ends = np.cumsum(lengths, dtype=np.int64)
                for key, n, e in zip(keys, lengths.tolist(), ends.tolist()):
                    out[0].append(key)
                    out[1].append(start + e - n)
                    out[2].append(n)
                    out[3].append(zlib.crc32(raw[4 * (e - n) : 4 * e]))
            return out

        return f

    sizes = segments.groupBy("part").agg(F.sum("n_ids").alias("ids"))  # one row a partition of the writing job
    parts = sizes.select("part", (F.sum("ids").over(Window.orderBy("part")) - F.col("ids")).alias("start"))
    # as many rows as the writing job had partitions, so the payloads need no shuffle
    placed = segments.join(F.broadcast(parts), "part").select((F.col("start") + F.col("before")).alias("start"), "payload")
    return map_rows(placed, [F.col("start"), F.col("payload")], make, f"{id_col} long, start long, n_tokens long, ids_crc32 long", 4)


#: Memo entries (distinct white-space chunks, distinct words) a worker keeps.
MEMO, WORD_MEMO = 800_000, 900_000
#: Runs of punctuation a worker remembers.
TAILS = 10_000
_PLAIN = re.compile("[\x1c-\x1fİ̀-\U0010ffff]|<\\|")


@lru_cache(4)
def library_encoder(path: str):
    """f(texts) -> ids by the tokenizers library. Plain texts are encoded chunk by chunk through a memo, which is exact
    because the file's pattern never crosses white space; texts with special strings or other scripts go whole."""
    import os

    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(path)
    t.no_truncation()
    t.no_padding()

    ends_word = np.zeros(t.get_vocab_size(), bool)
    for name, i in t.get_vocab().items():
        ends_word[i] = name.endswith("</w>")

    def encode_words(words: list[str]):
        """Many words a call. Words of letters only end with a word-end token each; others are told apart by their places."""
        lens = np.zeros(len(words), np.int64)
        parts, order = [], []
        letters = np.array([w.isalpha() for w in words], bool)
        for plain, index in ((True, np.flatnonzero(letters)), (False, np.flatnonzero(~letters))):
            for k in range(0, len(index), 4096):
                at = index[k : k + 4096]
                part = [words[i] for i in at]
                if plain:
                    ids = np.array(t.encode_batch_fast([" ".join(part)], add_special_tokens=False)[0].ids, np.int32)
                    cuts = np.flatnonzero(ends_word[ids]) + 1
                else:
                    e = t.encode(" ".join(part), add_special_tokens=False)
                    ids = np.array(e.ids, np.int32)
                    ends = np.cumsum(np.fromiter(map(len, part), np.int64, len(part)) + 1)
                    cuts = np.searchsorted(np.array([o[0] for o in e.offsets], np.int64), ends)
                lens[at] = np.diff(cuts, prepend=0)
                parts.append(ids)
                order.append(at)
        flat, order = np.concatenate(parts), np.concatenate(order)
        own = lens[order]
        back = np.empty(len(order), np.int64)  # from the order of encoding to that of the words
        back[order] = np.cumsum(own) - own
        total = np.cumsum(lens)
        return flat[np.repeat(back - (total - lens), lens) + np.arange(int(total[-1]))], lens

    words = RaggedMemo(encode_words, WORD_MEMO)
    tails: dict[str, list[int]] = {}

    def tail_ids(tail: str) -> list[int]:
        if tail not in tails:
            if len(tails) >= TAILS:
                tails.clear()
            tails[tail] = t.encode(tail, add_special_tokens=False).ids
        return tails[tail]

    def encode_chunks(chunks: list[str]):
        """A run of punctuation that ends a chunk is a word of its own behind a letter, so chunks that differ in it share their word."""
        heads = [c.rstrip(punctuation) for c in chunks]
        cut = [k for k, (h, c) in enumerate(zip(heads, chunks)) if len(h) < len(c) and h and h[-1].isalpha()]
        own = list(chunks)
        for k in cut:
            own[k] = heads[k]
        flat, lens = words.lookup(own)
        if not cut:
            return flat, lens
        ids = [tail_ids(chunks[k][len(heads[k]) :]) for k in cut]
        more = np.fromiter(map(len, ids), np.int64, len(ids))
        flat = np.insert(flat, np.repeat(np.cumsum(lens)[cut], more), [i for x in ids for i in x])
        lens = lens.copy()
        lens[cut] += more
        return flat, lens

    memo = RaggedMemo(encode_chunks, MEMO)

    def odd(text: str) -> bool:
        """Special strings, other scripts, or one of the separators that only str.split takes for white space."""
        if "<|" in text:
            return True
        try:
            raw = text.encode("latin-1")
        except UnicodeEncodeError:
            return _PLAIN.search(text) is not None
        return any(c in raw for c in (b"\x1c", b"\x1d", b"\x1e", b"\x1f"))

    def f(texts: list[str]) -> list[np.ndarray]:
        whole = [odd(x) for x in texts]
        flat, ends = memo.texts([[] if o else x.lower().split() for x, o in zip(texts, whole)])
        rows = np.split(flat, ends[:-1]) if len(texts) else []
        return [np.array(t.encode(x, add_special_tokens=False).ids, np.int32) if o else r for x, o, r in zip(texts, whole, rows)]

    return f


def op9_simple8b(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    path = public_tokenizers.path("word_bpe_49k.json")
    return read_ids(write_ids(read(spark, sf_dir, "documents"), lambda: library_encoder(path), 1))


QUERIES = {"op9_simple8b": op9_simple8b}
ORACLES: dict[str, str] = {}
CACHES[__name__] = [library_encoder.cache_clear]
