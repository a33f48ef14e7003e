"""TIFF media columns: a reader that emits one row per page, and a small writer.

The reader walks the chain of image directories in either byte order, decodes
strips and tiles that are stored plain, as PackBits, LZW or deflate, undoes the
horizontal predictor, joins separate planes and yields interleaved samples.

Samples of 1, 2 and 4 bits come back as a byte each.

Edge cases: a null or empty file has no pages; a page that cannot be decoded gives
a row with ``error`` set and null samples, and the walk goes on; a broken chain
ends it with such a row without a page number. Directory loops end the walk with
an error. Repeated rows give repeated pages.
"""

from __future__ import annotations

import hashlib
import struct
import zlib
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ._common import col, map_batches, map_rows, read

# Fixed values of the TIFF 6.0 format.
NONE, LZW, DEFLATE, PACKBITS, OLD_DEFLATE = 1, 5, 8, 32773, 32946
_SIZES = {1: 1, 2: 1, 3: 2, 4: 4, 5: 8, 6: 1, 7: 1, 8: 2, 9: 4, 10: 8, 11: 4, 12: 8, 13: 4}
_CODES = {1: "B", 3: "H", 4: "I", 6: "b", 8: "h", 9: "i", 13: "I"}
WIDTH, HEIGHT, BITS, COMPRESSION, PHOTO, OFFSETS, SAMPLES, ROWS, COUNTS, PLANAR, PREDICTOR, FILL = 256, 257, 258, 259, 262, 273, 277, 278, 279, 284, 317, 266
TILE_W, TILE_H, TILE_OFFSETS, TILE_COUNTS = 322, 323, 324, 325


#: No codec here makes more bytes of one.
MOST = 4096


def unpack_bits(data: bytes) -> bytes:
    out, i, n = [], 0, len(data)
    while i < n:
        c = data[i]
        if c < 128:
            out.append(data[i + 1 : i + 2 + c])
            i += c + 2
        elif c > 128:
            out.append(data[i + 1 : i + 2] * (257 - c))
            i += 2
        else:
            i += 1
    return b"".join(out)


def pack_bits(row: bytes) -> bytes:
    """Runs of three and more as repeats, the rest as literals."""
    a = np.frombuffer(row, np.uint8)
    edges = np.flatnonzero(np.diff(a)) + 1
    starts, ends = np.concatenate([[0], edges]), np.concatenate([edges, [len(a)]])
    long = ends - starts >= 3
    out, done = [], 0

    def literal(i: int, j: int) -> None:
        for k in range(i, j, 128):
            out.append(bytes([min(128, j - k) - 1]) + row[k : min(k + 128, j)])

    for s, e in zip(starts[long].tolist(), ends[long].tolist()):
        literal(done, s)
        while e - s >= 2:
            m = min(128, e - s)
            out.append(bytes([257 - m, row[s]]))
            s += m
        done = s
    literal(done, len(row))
    return b"".join(out)


def unlzw(data: bytes) -> bytes:
    """MSB-first codes of 9 to 12 bits that widen one code early; 256 clears, 257 ends."""
    out, table, prev = [], [], b""
    width, acc, have = 9, 0, 0
    fresh = [bytes([i]) for i in range(256)] + [b"", b""]
    table = fresh[:]
    for byte in data:
        acc, have = (acc << 8) | byte, have + 8
        if have < width:
            continue
        have -= width
        code, acc = acc >> have, acc & ((1 << have) - 1)
        if code == 256:
            table, width, prev = fresh[:], 9, b""
            continue
        if code == 257:
            break
        if not prev:
            entry = table[code]
        else:
            if code > len(table):
                raise ValueError("LZW code out of range")
            entry = table[code] if code < len(table) else prev + prev[:1]
            table.append(prev + entry[:1])
        out.append(entry)
        prev = entry
        if (n := len(table)) >= 511:
            width = 10 if n < 1023 else 11 if n < 2047 else 12
    return b"".join(out)


def lzw(data: bytes) -> bytes:
    codes: list[tuple[int, int]] = [(256, 9)]
    table, width, w = {bytes([i]): i for i in range(256)}, 9, b""
    nxt = 258
    for i in range(len(data)):
        c = data[i : i + 1]
        if w + c in table:
            w += c
            continue
        codes.append((table[w], width))
        table[w + c] = nxt
        nxt += 1
        if nxt == 4094:
            codes.append((256, width))
            table, width, nxt = {bytes([k]): k for k in range(256)}, 9, 258
        elif nxt >= 512:  # a reader's table is one entry behind
            width = 10 if nxt < 1024 else 11 if nxt < 2048 else 12
        w = c
    if w:
        codes.append((table[w], width))
        nxt += 1
        if nxt >= 512:
            width = 10 if nxt < 1024 else 11 if nxt < 2048 else 12
    codes.append((257, width))
    acc, have, out = 0, 0, bytearray()
    for code, wid in codes:
        acc, have = (acc << wid) | code, have + wid
        while have >= 8:
            have -= 8
            out.append(acc >> have)
            acc &= (1 << have) - 1
    if have:
        out.append((acc << (8 - have)) & 255)
    return bytes(out)


_DECODE = {NONE: bytes, LZW: unlzw, DEFLATE: zlib.decompress, OLD_DEFLATE: zlib.decompress, PACKBITS: unpack_bits}
_ENCODE = {NONE: bytes, LZW: lzw, DEFLATE: lambda b: zlib.compress(b, 1), PACKBITS: pack_bits}


def _tags(data: bytes, at: int, order: str) -> dict[int, tuple]:
    (n,) = struct.unpack_from(order + "H", data, at)
    tags: dict[int, tuple] = {}
    for i in range(n):
        tag, kind, count = struct.unpack_from(order + "HHI", data, at + 2 + 12 * i)
        size = _SIZES.get(kind, 1) * count
        pos = at + 10 + 12 * i if size <= 4 else struct.unpack_from(order + "I", data, at + 10 + 12 * i)[0]
        if kind in _CODES:
            tags[tag] = struct.unpack_from(f"{order}{count}{_CODES[kind]}", data, pos)
    return tags


def _directories(data: bytes) -> Iterator[tuple[int, int, str]]:
    """(page, place, byte order) along the chain of directories."""
    if not data:
        return
    order = {b"II": "<", b"MM": ">"}.get(data[:2])
    if order is None or struct.unpack_from(order + "H", data, 2)[0] != 42:
        raise ValueError("not a TIFF file")
    (at,) = struct.unpack_from(order + "I", data, 4)
    seen: set[int] = set()
    while at:
        if at in seen:
            raise ValueError("directories form a loop")
        seen.add(at)
        (n,) = struct.unpack_from(order + "H", data, at)
        (after,) = struct.unpack_from(order + "I", data, at + 2 + 12 * n)
        yield len(seen) - 1, at, order
        at = after


def _page(data: bytes, page: int, at: int, order: str) -> dict:
    tags = _tags(data, at, order)
    one = lambda tag, default: tags.get(tag, (default,))[0]
    w, h, spp, bits = one(WIDTH, 0), one(HEIGHT, 0), one(SAMPLES, 1), one(BITS, 1)
    if bits not in (1, 2, 4, 8, 16):
        raise ValueError(f"{bits} bits a sample")
    dtype = np.dtype("u1") if bits <= 8 else np.dtype(order + "u2")
    comp, pred, planar = one(COMPRESSION, 1), one(PREDICTOR, 1), one(PLANAR, 1)
    planes, per = (spp, 1) if planar == 2 else (1, spp)
    if w * h * spp * dtype.itemsize > MOST * (len(data) + 1):
        raise ValueError(f"{w} x {h} pixels in a file of {len(data)} bytes")
    tiled = TILE_OFFSETS in tags
    cw, ch = (one(TILE_W, w), one(TILE_H, h)) if tiled else (w, min(one(ROWS, h), h) or 1)
    offsets, counts = (tags[TILE_OFFSETS], tags[TILE_COUNTS]) if tiled else (tags[OFFSETS], tags[COUNTS])
    across, down = -(-w // cw) if w else 0, -(-h // ch) if h else 0
    if min(len(offsets), len(counts)) < across * down * planes:
        raise ValueError("strips or tiles are missing")
    if cw * ch * per * dtype.itemsize > MOST * (len(data) + 1):
        raise ValueError(f"tiles of {cw} x {ch} pixels in a file of {len(data)} bytes")
    image = np.zeros((h, w, spp), dtype)
    for k, (o, c) in enumerate(zip(offsets, counts)):
        plane, rest = divmod(k, across * down)
        y, x = (rest // across) * ch, (rest % across) * cw
        rows = ch if tiled else min(ch, h - y)
        raw = data[o : o + c]
        if one(FILL, 1) == 2:
            raw = np.packbits(np.unpackbits(np.frombuffer(raw, np.uint8), bitorder="little")).tobytes()
        raw = _DECODE[comp](raw)
        if bits < 8:  # each row starts a byte
            line = -(-cw * per * bits // 8)
            each = np.unpackbits(np.frombuffer(raw[: rows * line], np.uint8).reshape(rows, line), axis=1)[:, : cw * per * bits]
            part = (each.reshape(rows, cw, per, bits) @ (1 << np.arange(bits)[::-1])).astype(np.uint8)
        else:
            part = np.frombuffer(raw[: rows * cw * per * dtype.itemsize], dtype).reshape(rows, cw, per)
        if pred == 2:
            part = np.cumsum(part, axis=1, dtype=dtype.newbyteorder("="))
            if bits < 8:
                part &= (1 << bits) - 1
        elif pred != 1:
            raise ValueError(f"predictor {pred}")
        part = part[: h - y, : w - x]
        if planes == 1:
            image[y : y + part.shape[0], x : x + part.shape[1]] = part
        else:
            image[y : y + part.shape[0], x : x + part.shape[1], plane] = part[:, :, 0]
    return {"page": page, "width": w, "height": h, "samples": spp, "bits": bits, "compression": comp, "predictor": pred, "tiled": tiled, "data": image.tobytes()}


def pages(data: bytes) -> Iterator[dict]:
    """One dict per image directory: page, width, height, samples, bits, compression, predictor, tiled, data (interleaved)."""
    return (_page(data, *d) for d in _directories(data))


def write(images: list[np.ndarray], compression: int = DEFLATE, predictor: int = 1, rows: int = 256, tile: int | None = None, order: str = "<", planar: int = 1) -> bytes:
    """8-bit images (height, width, samples) as a TIFF file with one directory each, in strips of ``rows`` or square tiles."""
    out = bytearray((b"II" if order == "<" else b"MM") + struct.pack(order + "HI", 42, 0))
    link = 4
    for image in images:
        h, w, spp = image.shape
        ch, cw = (tile, tile) if tile else (rows, w)
        offsets, counts = [], []
        for plane in [image] if planar == 1 else [image[:, :, k : k + 1] for k in range(spp)]:
            for y in range(0, h, ch):
                for x in range(0, w, cw):
                    part = plane[y : y + ch, x : x + cw]
                    if tile and part.shape[:2] != (ch, cw):
                        part = np.pad(part, ((0, ch - part.shape[0]), (0, cw - part.shape[1]), (0, 0)))
                    if predictor == 2:
                        part = np.diff(part, axis=1, prepend=np.zeros((part.shape[0], 1, part.shape[2]), np.uint8))
                    body = np.ascontiguousarray(part, np.uint8)
                    raw = b"".join(pack_bits(r.tobytes()) for r in body) if compression == PACKBITS else _ENCODE[compression](body.tobytes())
                    offsets.append(len(out))
                    counts.append(len(raw))
                    out += raw
        tags = [(WIDTH, 4, [w]), (HEIGHT, 4, [h]), (BITS, 3, [8] * spp), (COMPRESSION, 3, [compression]), (PHOTO, 3, [2 if spp == 3 else 1]), (SAMPLES, 3, [spp]), (PLANAR, 3, [planar]), (PREDICTOR, 3, [predictor])]
        tags += [(TILE_W, 4, [cw]), (TILE_H, 4, [ch]), (TILE_OFFSETS, 4, offsets), (TILE_COUNTS, 4, counts)] if tile else [(OFFSETS, 4, offsets), (ROWS, 4, [ch]), (COUNTS, 4, counts)]
        entries = []
        for tag, kind, values in sorted(tags):
            raw = struct.pack(f"{order}{len(values)}{_CODES[kind]}", *values)
            if len(raw) > 4:
                out += b"\0" * (len(out) % 2)
                raw, at = struct.pack(order + "I", len(out)), raw
                out += at
            entries.append(struct.pack(order + "HHI", tag, kind, len(values)) + raw.ljust(4, b"\0"))
        out += b"\0" * (len(out) % 2)
        struct.pack_into(order + "I", out, link, len(out))
        out += struct.pack(order + "H", len(entries)) + b"".join(entries)
        link = len(out)
        out += b"\0\0\0\0"
    return bytes(out)


PAGE_SCHEMA = "id long, page int, width long, height long, samples int, bits int, compression int, predictor int, tiled boolean, data binary, error string"


def decode_pages(df: DataFrame, media: str = "media", id_col: str = "doc_id", keep: str = "") -> DataFrame:
    """One row per page of every file in the binary column ``media``, a file's pages in order behind each other; the id column
    comes back under its own name, columns of the schema ``keep`` behind the page's."""
    kept = [x.split()[0] for x in keep.split(",")] if keep else []

    def make():
        broken = (ValueError, KeyError, IndexError, ZeroDivisionError, OverflowError, struct.error, zlib.error)

        def f(ids, files, *more):
            rows = []
            for i, data, *own in zip(ids, files, *more):
                try:
                    for d in _directories(data or b""):
                        try:
                            rows.append((i, *_page(data, *d).values(), None, *own))
                        except broken as e:
                            rows.append((i, d[0], *[None] * 8, f"{type(e).__name__}: {e}", *own))
                except broken as e:
                    rows.append((i, *[None] * 9, f"{type(e).__name__}: {e}", *own))
            return list(zip(*rows)) if rows else None

        return f

    schema = PAGE_SCHEMA + (", " + keep if keep else "")
    return map_rows(df, [col(id_col).cast("long"), col(media), *map(col, kept)], make, schema, 64).withColumnRenamed("id", id_col)


#: A document's payload is dealt to pages of this many rows of 64 RGB pixels.
PAGE_ROWS = 2048


def text_media(raw: bytes) -> bytes:
    """A payload of whole rows (192 bytes) as TIFF pages. The codec follows the payload's checksum, so equal texts give equal files."""
    rows = np.frombuffer(raw, np.uint8).reshape(-1, 64, 3)
    images = [rows[k : k + PAGE_ROWS] for k in range(0, len(rows), PAGE_ROWS)]
    kind, other = zlib.crc32(raw) % 4, zlib.crc32(raw) >> 2 & 1
    if kind == 0:
        return write(images, PACKBITS, 1, 64)
    if kind == 1:
        return write(images, DEFLATE, 2, tile=64, planar=1 + other)
    if kind == 2:
        return write(images, LZW, 1 + other, 256, tile=64 if other else None)
    return write(images, DEFLATE, 1 + other, 256)


MEDIA = "n_bytes long, media_bytes long, media_sha256 string"
DIGESTS = "doc_id long, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string"


def _digests(batches):
    """Rows of pages, a file's behind each other, as one row a file."""
    import pyarrow as pa

    schema = pa.schema([(n, pa.string() if t == "string" else pa.int64()) for n, t in (x.split() for x in DIGESTS.split(", "))])

    def row(r, n, size, digest, levels, tail):
        feature = f"pages={n};codec={r['compression']};predictor={r['predictor']};tiled={int(r['tiled'])};levels={','.join(map(str, levels.tolist()))}"
        return r["doc_id"], r["n_bytes"], size, digest.hexdigest(), zlib.crc32(tail), r["media_bytes"], r["media_sha256"], feature

    now, out = None, []
    for b in (whole.slice(k, 64) for whole in batches for k in range(0, whole.num_rows, 64)):
        for r in b.to_pylist():
            if r["error"] is not None:
                raise ValueError(r["error"])  # our own file: nothing may be lost silently
            if r["page"] == 0:
                if now:
                    out.append(row(*now))
                now = [{**r, "data": None}, 0, 0, hashlib.sha256(), np.zeros(4, np.int64), b""]
            data = r["data"]
            now[1] += 1
            now[2] += len(data)
            now[3].update(data)
            now[4] += np.bincount(np.frombuffer(data, np.uint8) >> 6, minlength=4)
            now[5] = (now[5] + data[-16:])[-16:]
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), schema)], schema=schema)
            out = []
    if now:
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(row(*now)), schema)], schema=schema)


def op10_tiff_media(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every text as TIFF, read back by decode_pages, a row a page; digests of what came back. No shuffle."""
    def make():
        def f(ids, texts):
            rows = []
            for i, text in zip(ids, texts):
                raw = (text or "").encode()
                media = text_media(raw + b" " * (-len(raw) % 192 if raw else 192))
                rows.append((i, media, len(raw), len(media), hashlib.sha256(media).hexdigest()))
            return list(zip(*rows))

        return f

    media = map_rows(read(spark, sf_dir, "documents"), [F.col("doc_id").cast("long"), F.col("text")], make, "doc_id long, media binary, " + MEDIA, 64)
    return map_batches(decode_pages(media, keep=MEDIA), _digests, DIGESTS)


QUERIES = {"op10_tiff_media": op10_tiff_media}
ORACLES: dict[str, str] = {}
