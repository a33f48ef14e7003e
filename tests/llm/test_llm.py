"""Operators against brute force, round trips and edge cases."""

import collections
import hashlib
import itertools
import random
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from entityflow.llm import bpe, chat, decontaminate, maxent, pii, shingle_join, simple8b, tiff, token_counts, toxicity, words

P = pytest.importorskip("public_tokenizers")
DOCS = "doc_id long, text string, lang string, source string, n_chars long, ids string, `a.b` int"
BPE = P.path("word_bpe_49k.json")
rng = random.Random(7)
VOCAB = ["".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 7))) for _ in range(400)]


def prose(n, seed):
    r = random.Random(seed)
    return " ".join(r.choice(VOCAB) for _ in range(n))


@pytest.fixture(scope="module")
def odd(spark):
    """Nulls, empty and blank texts, a long unsplit text, repeated rows, clashing extra columns."""
    long = "x" * 30_000 + " " + prose(3000, 1)
    rows = [(1, None), (2, ""), (3, "  \n\t"), (4, long), (5, prose(60, 2)), (5, prose(60, 2)), (None, prose(60, 2)), (7, "Ünïcode ΣΑΣ 🙂 <|endoftext|> it's 1²"), (8, prose(60, 2))]
    return spark.createDataFrame([(i, t, None, "s", None, "q", 1) for i, t in rows], DOCS)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], DOCS)


TEXT = st.text(alphabet="ab  c.,'\n\té🙂ΣLT<|endoftext|>19", max_size=80)


@settings(max_examples=200, deadline=None)
@given(TEXT)
def test_bpe_and_library_memo_equal_the_library(text):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(BPE)
    v = bpe.vocabulary(BPE)
    want = t.encode(text, add_special_tokens=False).ids
    got = v.encode_texts([text], bpe.memo(BPE))[0].tolist()
    assert got == want == simple8b.library_encoder(BPE)([text])[0].tolist()
    assert v.decode(got) == t.decode(want, skip_special_tokens=False)


@settings(max_examples=60, deadline=None)
@given(st.text(alphabet="abehint", min_size=1, max_size=400))
def test_tree_concatenation_equals_one_pass(word):
    v = bpe.vocabulary(BPE)
    assert v.encode_word(word) == v.heap(v.symbols(word))


def test_bpe_operator(spark, odd, none):
    got = bpe.encode(odd, BPE).collect()
    assert len(got) == 9 and bpe.encode(none, BPE).count() == 0
    spread = sorted(map(str, bpe.encode(odd, BPE, spread=20).collect()))
    assert spread == sorted(map(str, got))
    back = {r["doc_id"]: r["text"] for r in bpe.decode(bpe.encode(odd, BPE), BPE).collect()}
    assert back[1] == back[2] == back[3] == ""
    for wrong in (10**6, -1):
        with pytest.raises(KeyError):
            bpe.vocabulary(BPE).decode([5, wrong])
    chunked = bpe._encode_spread(spark.createDataFrame([("k", "ab" * 500 + " the " + "the" * 300)], "key string, text string"), BPE, 100).first()["ids"]
    from tokenizers import Tokenizer

    assert chunked == Tokenizer.from_file(BPE).encode("ab" * 500 + " the " + "the" * 300, add_special_tokens=False).ids


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(alphabet="ab the▁\n\t日🙂<s>/", max_size=60), max_size=5))
def test_token_counts_equal_the_library(texts):
    import sentencepiece

    file = P.path("piece_bpe_32k.model")
    m = sentencepiece.SentencePieceProcessor(model_file=file)
    assert token_counts.Counter(file)(texts) == [len(m.encode(t)) for t in texts]


def test_token_count_operator(odd, none):
    file = P.path("piece_bpe_32k.model")
    got = token_counts.count_tokens(odd, file).collect()
    assert len(got) == 9 and [r["n_tokens"] for r in got if r["doc_id"] in (1, 2)] == [0, 0]
    assert token_counts.count_tokens(none, file).count() == 0


@settings(max_examples=100, deadline=None)
@given(st.lists(st.one_of(st.integers(0, 3), st.integers(0, 50_000), st.integers(0, 2**64 - 1), st.just(0), st.just(2**60 - 1)), max_size=400))
def test_simple8b_round_trip(ids):
    x = np.array(ids, np.uint64)
    w, raw = simple8b.pack(x)
    assert (simple8b.unpack(w, len(x), raw) == x).all()
    keys, lengths, back = simple8b.read_segment(simple8b.segment([None, 3], [x, x[:2]]))
    assert keys == [None, 3] and lengths.tolist() == [len(x), len(x[:2])] and (back == np.concatenate([x, x[:2]])).all()


def test_simple8b_files(odd, none):
    encoder = lambda: simple8b.library_encoder(BPE)
    got = simple8b.read_ids(simple8b.write_ids(odd, encoder, 1)).orderBy("start").collect()
    assert [r["doc_id"] for r in got] == [None, 1, 2, 3, 4, 5, 5, 7, 8]
    assert all(b["start"] == a["start"] + a["n_tokens"] for a, b in itertools.pairwise(got))
    assert got[1]["ids_crc32"] == zlib.crc32(np.array([1], "<u4").tobytes())
    assert simple8b.read_ids(simple8b.write_ids(none, encoder, 1)).count() == 0


@pytest.mark.parametrize("codec", [tiff.NONE, tiff.LZW, tiff.DEFLATE, tiff.PACKBITS])
@pytest.mark.parametrize("tile", [None, 16])
def test_tiff_round_trip(codec, tile):
    r = np.random.default_rng(1)
    images = [r.integers(0, hi, (h, 23, 3)).astype(np.uint8) for hi, h in ((3, 37), (256, 90))]
    for pred, order, planar in itertools.product((1, 2), "<>", (1, 2)):
        got = list(tiff.pages(tiff.write(images, codec, pred, 10, tile, order, planar)))
        assert [g["data"] for g in got] == [i.tobytes() for i in images]


def test_tiff_rows(spark):
    import struct

    good = tiff.write([np.zeros((2, 3, 1), np.uint8)] * 2)
    df = spark.createDataFrame([(1, bytearray(good)), (2, bytearray(b"junk")), (3, None), (4, bytearray()), (5, bytearray(good[:20]))], "doc_id long, media binary")
    got = tiff.decode_pages(df).collect()
    assert collections.Counter(r["doc_id"] for r in got) == {1: 2, 2: 1, 5: 1} and [r["error"] is None for r in got] == [True, True, False, False]

    def changed(media, tag, value, page=0):
        """The file with another value (or, for tag 0, another next directory) in a page's directory."""
        out = bytearray(media)
        at = struct.unpack_from("<I", out, 4)[0]
        for _ in range(page):
            at = struct.unpack_from("<I", out, at + 2 + 12 * struct.unpack_from("<H", out, at)[0])[0]
        n = struct.unpack_from("<H", out, at)[0]
        if not tag:
            struct.pack_into("<I", out, at + 2 + 12 * n, struct.unpack_from("<I", out, 4)[0])
        for i in range(n):
            if struct.unpack_from("<H", out, at + 2 + 12 * i)[0] == tag:
                struct.pack_into("<I", out, at + 10 + 12 * i, value)
        return out

    tiles = tiff.write([np.zeros((40, 30, 1), np.uint8)] * 2, tile=16)
    files = [changed(tiles, tiff.TILE_W, 0), changed(good, 0, 0, page=1), changed(good, tiff.WIDTH, 2**31), changed(good, tiff.HEIGHT, 2**32 - 1, page=1), changed(tiles, tiff.TILE_H, 2**30), changed(good, tiff.ROWS, 0), changed(good, tiff.COMPRESSION, 99), changed(good, tiff.OFFSETS, 10**6)]
    got = tiff.decode_pages(spark.createDataFrame(list(enumerate(files)), "doc_id long, media binary")).collect()
    ok = {i: [r["error"] is None for r in got if r["doc_id"] == i] for i in range(len(files))}
    # a loop ends the walk behind its good pages with one error row; other faults cost their page only
    assert ok == {0: [False, True], 1: [True, True, False], 2: [False, True], 3: [True, False], 4: [False, True], 5: ok[5], 6: [False, True], 7: [False, True]} and len(ok[5]) == 2


def test_tiff_few_bits_failing_pages_and_lzw(spark, tmp_path):
    import struct

    def page(at, bits, comp, raw, more):
        """An uncompressed strip of 5 x 2 grey samples and its directory behind it."""
        tags = [(256, 5), (257, 2), (258, bits), (259, comp), (262, 1), (273, at), (277, 1), (278, 2), (279, len(raw)), (284, 1)]
        body = raw + b"\0" * (len(raw) % 2)
        directory = struct.pack("<H", len(tags)) + b"".join(struct.pack("<HHII", t, 4, 1, v) for t, v in tags)
        return body + directory + struct.pack("<I", at + len(body) + len(directory) + 4 + more if more >= 0 else 0)

    want = {1: [1, 0, 1, 1, 0, 0, 1, 1, 0, 1], 2: [3, 0, 1, 2, 0, 1, 1, 3, 2, 2], 4: [15, 0, 7, 9, 1, 2, 3, 4, 5, 6]}
    packed = {b: b"".join(np.packbits(np.array([[x >> k & 1 for k in range(b)[::-1]] for x in v[5 * r : 5 * r + 5]], np.uint8).ravel()).tobytes() for r in (0, 1)) for b, v in want.items()}
    raws = [(1, 1, packed[1]), (2, 1, packed[2]), (3, 1, b"xx"), (1, tiff.PACKBITS, tiff.pack_bits(packed[1])), (4, 1, packed[4])]
    out = struct.pack("<2sHI", b"II", 42, 8 + len(raws[0][2]))
    for k, (bits, comp, raw) in enumerate(raws):
        after = len(raws[k + 1][2]) + len(raws[k + 1][2]) % 2 if k + 1 < len(raws) else -1
        out += page(len(out), bits, comp, raw, after)
    rows = tiff.decode_pages(spark.createDataFrame([(1, bytearray(out))], "doc_id long, media binary")).collect()
    assert [r["page"] for r in rows] == [0, 1, 2, 3, 4] and [r["error"] is None for r in rows] == [True, True, False, True, True]
    assert [list(r["data"]) for r in rows if r["data"] is not None] == [want[1], want[2], want[1], want[4]]

    docs = [(i, prose(i % 40, i)) for i in range(80)] + [(None, "q"), (3, prose(3, 3)), (90, None), (91, prose(40_000, 1) * 3)]
    spark.createDataFrame(docs, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = tiff.op10_tiff_media(spark, str(tmp_path)).collect()
    full = lambda t: (raw := (t or "").encode()) + b" " * (-len(raw) % 192 if raw else 192)
    assert collections.Counter((r["doc_id"], r["payload_sha256"], r["tail_crc32"]) for r in got) == collections.Counter((i, hashlib.sha256(full(t)).hexdigest(), zlib.crc32(full(t)[-16:])) for i, t in docs)
    assert {("codec=5" in r["feature"], "tiled=1" in r["feature"]) for r in got} == set(itertools.product((True, False), repeat=2))
    assert any("pages=2;" in r["feature"] for r in got)


def links(sets, t):
    """Brute-force components."""
    par = list(range(len(sets)))

    def find(a):
        while par[a] != a:
            a = par[a]
        return a

    for a, b in itertools.combinations(range(len(sets)), 2):
        if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= t * len(sets[a] | sets[b]):
            x, y = find(a), find(b)
            par[max(x, y)] = min(x, y)
    return [find(a) for a in range(len(sets))]


@pytest.mark.parametrize("k,t", [(3, 90), (5, 80)])
def test_shingle_join(spark, k, t):
    r = random.Random(3)
    texts = [prose(r.randint(0, 120), i) for i in range(60)]
    for base in range(8):
        for _ in range(12):
            w = texts[base + 30].split()
            for _ in range(r.randint(0, 4)):
                if w:
                    w[r.randrange(len(w))] = r.choice(VOCAB)
            texts.append(" ".join(w))
    texts += [texts[31].upper(), "", "a b", "A  B", "\n", None]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {x["id"]: (x["n"], x["component"]) for x in shingle_join.components(df, k, t).collect()}

    def shingles(text):
        w = (text or "").encode().lower().split()
        return {tuple(w[i : i + k]) for i in range(max(1, len(w) - k + 1))} if w else set()

    sets = [shingles(x) for x in texts]
    assert got == {i: (len(s), c) for i, (s, c) in enumerate(zip(sets, links(sets, t)))}
    pairs = {(a, b): len(sets[a] & sets[b]) for a, b in itertools.combinations(range(len(sets)), 2) if sets[a] and 100 * len(sets[a] & sets[b]) >= t * len(sets[a] | sets[b])}
    first = {i: min(j for j, s in enumerate(sets) if s == sets[i]) for i in range(len(sets)) if sets[i]}
    made, member = shingle_join.links(df, k, t)
    assert {(x["a"], x["b"]): (x["shared"], x["n_a"], x["n_b"]) for x in made.collect()} == {p: (n, len(sets[p[0]]), len(sets[p[1]])) for p, n in pairs.items() if first[p[0]] != first[p[1]] and p == (first[p[0]], first[p[1]])}
    assert {x["id"]: x["class"] for x in member.collect()} == first
    ends = collections.Counter(i for p in pairs for i in p)
    assert {x["id"]: (x["class"], x["links"]) for x in shingle_join.link_counts(df, k, t).collect()} == {i: (first.get(i), ends[i]) for i in range(len(sets))}


def test_shingle_join_on_many_near_copies_and_hot_keys(spark, monkeypatch):
    r = random.Random(8)
    monkeypatch.setattr(shingle_join, "HOT", 20)
    monkeypatch.setattr(shingle_join, "HOT_MEANS", 0)
    base, passage = prose(150, 900).split(), prose(40, 901)
    texts = []
    for i in range(300):  # a group of near copies, some of which link only through others
        w = list(base)
        for _ in range(r.randint(0, 5)):
            w[r.randrange(len(w))] = f"x{r.randrange(10_000)}"
        texts.append(" ".join(w))
    texts += [prose(r.randint(5, 200), 1000 + i) + " " + passage for i in range(300)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(7, "doc_id")
    sets = [{tuple(w[i : i + 3]) for i in range(max(1, len(w) - 2))} for w in (t.lower().split() for t in texts)]
    assert {x["id"]: x["component"] for x in shingle_join.components(df).collect()} == dict(enumerate(links(sets, 90)))


def test_sizes_at_exactly_the_ratio_are_partners(spark):
    for t, n, m in ((80, 1_991_336, 2_489_170), (90, 10_020_492, 11_133_880)):
        post = spark.createDataFrame([("k", 1, n), ("k", 2, m), ("k", 3, 5)], "key string, id long, n long")
        assert n * 100 == m * t and {r["id"] for r in shingle_join._with_partner(post, t).collect()} == {1, 2}


def test_shingle_join_edges(odd, none):
    got = shingle_join.components(odd).collect()
    by = collections.defaultdict(set)
    for r in got:
        by[r["id"]].add((r["n"], r["component"]))
    assert len(got) == 9 and by[8] == {(58, 5)} and by[5] == {(58, 5)} and by[None] == {(58, None)} and by[1] == {(0, 1)}
    kept = shingle_join.one_of_each(odd)
    assert kept.columns == odd.columns and sorted(str(r["doc_id"]) for r in kept.collect()) == sorted(map(str, [1, 2, 3, 4, 5, 5, None, 7]))
    assert shingle_join.components(none).count() == 0 and shingle_join.one_of_each(none).count() == 0


def test_word_hashes():
    texts = ["A b,  c", None, "", "a\x0bb\xa0c é", prose(500, 3)]
    got = words.word_hashes(texts)
    for t, h in zip(texts, got):
        assert len(h) == len((t or "").encode().split())
    old, words.CHUNK = words.CHUNK, 64
    try:
        assert all((a == b).all() for a, b in zip(got, words.word_hashes(texts)))
    finally:
        words.CHUNK = old
    a, b = words.word_hashes(["x, y. (z)", "X y z"], strip=True)
    assert (a == b).all()


def test_decontaminate(spark, odd, none):
    item = prose(40, 99).split()
    near = list(item)
    for i in (5, 17, 30):
        near[i] = "zzz"
    texts = [prose(50, 4) + " " + " ".join(item).upper() + " " + prose(20, 5), prose(9, 6) + " " + ", ".join(near), prose(300, 7), " ".join(item[:8]), None]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    bench = spark.createDataFrame([(1, " ".join(item)), (2, None), (3, ""), (4, "tiny item here")], "item_id long, text string")
    assert sorted((r["doc_id"], r["item_id"]) for r in decontaminate.overlaps(docs, bench).collect()) == [(0, 1), (1, 1)]
    assert sorted(r["doc_id"] for r in decontaminate.clean_documents(docs, bench).collect()) == [2, 3, 4]
    assert decontaminate.overlaps(docs, bench, index_words=1).count() == 2
    assert decontaminate.overlaps(none, bench).count() == 0 and decontaminate.overlaps(odd, bench.limit(0)).count() == 0
    assert decontaminate.clean_documents(odd, bench).count() == 9


def test_decontaminate_sees_every_run_of_a_diagonal():
    item = [f"w{i}" for i in range(30)]
    doc = [*item[:11], *(f"x{i}" for i in range(6)), *item[17:]]
    doc[23] = "y"
    h = words.word_hashes([" ".join(doc)], strip=True)[0]
    assert list(decontaminate.Index([(1, " ".join(item))]).overlaps(h)) == [(0, 17, 13, 12)]
    r = random.Random(3)
    for _ in range(300):  # every segment whose prefixes and suffixes all score more than 0 lies in one of the runs
        same = np.array([r.random() < 0.7 for _ in range(r.randint(1, 25))])
        x, runs = np.where(same, 1, -2), decontaminate._runs(same)
        for a, b in itertools.combinations(range(len(x) + 1), 2):
            if (np.cumsum(x[a:b]) > 0).all() and (np.cumsum(x[a:b][::-1]) > 0).all():
                assert any(s <= a and b <= e for _, s, e in runs)


def test_decontaminate_recall():
    """Overlaps that meet the rule along the item's true diagonal, with words replaced at random: all of short items, 0.95 of longer ones."""
    r = random.Random(5)
    for n in (4, 5, 6, 7, 8, 9, 10, 11, 12, 15, 20, 40):
        for share in (0.1, 0.2):
            items = [[f"i{r.randrange(5000)}" for _ in range(n)] for _ in range(150)]
            index = decontaminate.Index([(i, " ".join(w)) for i, w in enumerate(items)])
            want = got = 0
            for i, w in enumerate(items):
                text = [x if r.random() >= share else f"z{r.randrange(9**9)}" for x in w]
                front, back = ([f"y{r.randrange(9**9)}" for _ in range(r.choice((0, 0, 1, 30)))] for _ in range(2))
                h = words.word_hashes([" ".join([*front, *text, *back])], strip=True)[0]
                if decontaminate._run(h, index.items[i][1], len(front))[2] >= decontaminate._need(index.items[i][1]):
                    want += 1
                    got += any(k == i for k, *_ in index.overlaps(h))
            assert want >= 10 and got >= want * (1 if n <= decontaminate.SHORT else 0.95), (n, share, got, want)
    assert all(any(all(m[i] == "0" for i in lost) for m in decontaminate.short_masks(n)) for n in range(1, 12) for lost in itertools.combinations(range(n), decontaminate._lacks(n)))


def test_decontaminate_repeated_words_and_blocks(spark):
    import time

    index = decontaminate.Index([(1, "a " * 2000)])
    h = words.word_hashes(["a " * 4000])[0]
    began = time.perf_counter()
    assert [(k, n, m) for k, _, n, m in index.overlaps(h)] == [(0, 2000, 2000)] and time.perf_counter() - began < 3
    bench = spark.createDataFrame([(i, prose(20, 700 + i)) for i in range(6)] + [(9, None), (10, "")], "item_id long, text string")
    docs = spark.createDataFrame([(i, prose(5, i) + " " + (prose(20, 700 + i) if i < 6 else "")) for i in range(9)], "doc_id long, text string")
    one, many = (decontaminate.overlaps(docs, bench, index_words=n) for n in (10**6, 25))
    assert sorted(one.collect()) == sorted(many.collect()) and {r["doc_id"] for r in one.collect()} == set(range(6))
    assert {r["doc_id"] for r in decontaminate.clean_documents(docs, bench, index_words=25).collect()} == {6, 7, 8}


def test_toxicity(spark, odd, none):
    r = random.Random(5)
    bad = ["vileword", "nastything", "awfulness"]
    rows = []
    for i in range(1200):
        toxic = i % 4 == 0
        w = prose(40, 1000 + i).split()
        if toxic:
            for _ in range(r.randint(1, 4)):
                w.insert(r.randrange(len(w)), r.choice(bad) + r.choice(["", "s", "ing"]))
        rows.append((i, " ".join(w), int(toxic)))
    docs = spark.createDataFrame([(i, t) for i, t, _ in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(i, y) for i, _, y in rows if i < 800] + [(None, 1), (5, None)], "doc_id long, toxic int")
    model = toxicity.train(docs, labels)
    assert model.cuts == sorted(model.cuts) and len(model.cuts) == 3
    got = {x["doc_id"]: x for x in toxicity.score(docs, model).collect()}
    held = [(got[i]["toxic"], bool(y)) for i, _, y in rows if i >= 800]
    assert sum(p == y for p, y in held) / len(held) > 0.98
    assert all(0 <= x["severity"] <= 3 for x in got.values())
    assert toxicity.non_toxic(odd, model).count() == 9 and toxicity.score(none, model).count() == 0
    assert not any(x["toxic"] for x in toxicity.score(docs, toxicity.train(docs, labels.limit(0))).collect())


def test_toxicity_fits_on_the_whole_sample():
    import inspect

    assert inspect.signature(toxicity.train).parameters["fit_rows"].default == toxicity.FIT_ROWS == 16_384


def test_toxicity_thresholds_are_at_the_likelihoods_top():
    """No step of a weight or an ordered threshold raises the ordinal likelihood; scores equal the plain formula; ties do not matter."""
    r = np.random.default_rng(4)
    rows = [np.flatnonzero(r.random(6) < 0.4) for _ in range(400)]
    true = np.array([2.0, -1.0, 1.0, 0.5, 0.0, -2.0])
    z = np.array([true[x].sum() for x in rows]) + r.logistic(size=400)
    grades = np.searchsorted([0.0, 1.5, 2.5], z)
    w, b = toxicity.fit_ordinal(rows, grades, 6, 4)
    sig = lambda x: 1 / (1 + np.exp(-x))

    def loss(w, b):
        s = np.array([w[x].sum() for x in rows])
        above = np.concatenate([np.ones((400, 1)), sig(s[:, None] - b), np.zeros((400, 1))], axis=1)
        return -np.log(above[np.arange(400), grades] - above[np.arange(400), grades + 1]).mean() + 0.5e-4 * (w**2).sum()

    best = loss(w, b)
    assert (np.diff(b) > 0).all() and np.abs(w - true).max() < 1
    for i in range(9):
        for step in (-0.02, 0.02):
            v, c = w.copy(), b.copy()
            (v if i < 6 else c)[i if i < 6 else i - 6] += step
            assert loss(v, c) > best - 1e-6
    model = toxicity.Model({11: 1.5, 12: -0.5, 13: 0.25}, [0.0, 1.0, 2.0])
    memo = toxicity._Memo(model.place)
    memo.update({"a": (0, 2), "b": (1,), "c": (2,), "d": ()})
    want = [sum(sig(x - np.array(model.cuts))) for x in (1.75, 1.25, 0, 0, 0.25)]
    got, first = model.severity(["a c d", "a b c", None, "", "c c"], memo)
    assert np.allclose(got, want) and np.allclose(first, [sig(1.75), sig(1.25), 0.5, 0.5, sig(0.25)])
    same = toxicity.fit([np.array([1, 2], np.uint32)] * 30 + [np.array([3], np.uint32)] * 90, np.arange(120) < 30)
    assert same.cuts == sorted(same.cuts)


SLOW = {
    0: r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", 1: r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", 2: r"[0-9]([\x20-]?[0-9])+", 3: r"\+[0-9][\x20().0-9-]+[0-9]",
}


def slow_spans(text):
    import re

    out = []
    for k, p in SLOW.items():
        for m in re.finditer(p, text):
            d = re.sub("[^0-9]", "", m[0])
            ok = k == 0 or k == 1 and all(int(x) <= 255 for x in m[0].split(".")) or k == 3 and 8 <= len(d) <= 15
            if k == 2 and 16 <= len(d) <= 19:
                x = [int(c) for c in reversed(d)]
                ok = (sum(x[::2]) + sum(sum(divmod(2 * c, 10)) for c in x[1::2])) % 10 == 0
            if ok:
                out.append((k, m.start(), m.end()))
    return out


@settings(max_examples=400, deadline=None)
@given(st.text(alphabet="a0149.@+- ()é-", max_size=60))
def test_base_spans_equal_the_plain_rules(text):
    assert pii.base_spans(text) == slow_spans(text)


def test_pii(spark, odd, none):
    rows = [(i, f"{prose(8, i)} badge number 4{i:03d}55{i:03d} please and mail a{i}@x{i}.org {prose(5, i)}") for i in range(30)]
    rows += [(100 + i, f"{prose(8, i)} contact phone +1 555 0{i:03d}22 today") for i in range(20)] + [(200, "contact phone 5550-99x today")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    trusted = pii.bootstrap(docs)
    assert trusted.get("l2 contact phone") == "phone" and "l2 badge number" not in trusted
    got = {r["doc_id"]: r for r in pii.extract(docs, trusted).collect()}
    assert got[200]["n_added"] == 1 and got[200]["spans"] == "phone:14:22" and got[200]["n_phone"] == 0
    assert got[3]["n_email"] == 1 and hashlib.sha256(",".join(f"email:{m}:{n}" for _, m, n in slow_spans(rows[3][1]) if _ == 0).encode()).hexdigest() == got[3]["base_sha256"]
    spans = pii.extract(odd, trusted).collect()
    assert collections.Counter(r["doc_id"] for r in spans) == collections.Counter([1, 2, 3, 4, 5, 5, None, 7, 8]) and all(r["spans"] == "" for r in spans if r["doc_id"] in (1, 2, 3))
    clean = pii.redact(odd, trusted)
    assert clean.columns == odd.columns and clean.count() == 9 and pii.redact(none, {}).count() == 0 and pii.bootstrap(none) == {}
    assert "[EMAIL]" in pii.redacted(rows[3][1], trusted)


def test_pii_patterns_need_the_same_seeds_at_every_size(spark):
    """Unrelated seeds (60,002 edges and more) take no pattern away; blocks of patterns give what one block gives."""
    rows = [(i, f"{prose(6, i)} zulu line +1 555 0{i:03d}22 stop") for i in range(3)]
    rows += [(100 + i, f"w{i} v{i} a{i}@x{i}.org u{i} {prose(3, i)}") for i in range(25_000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    trusted = pii.bootstrap(docs)
    assert trusted.get("l2 zulu line") == "phone" and trusted.get("l1 line") == "phone" and len(trusted) < 20
    some = spark.createDataFrame([(10, "zulu line 5550-99x stop"), (11, None), (None, "zulu line 5550-98x stop")], docs.schema)
    got = {r["doc_id"]: r["spans"] for r in pii.extract(some, trusted).collect()}
    assert got[10] == got[None] == "phone:10:18" and got[11] == ""
    known = {p: trusted[p] for p in trusted}
    for t in (trusted, known):
        assert {r["doc_id"]: r["spans"] for r in pii.extract(some, t, most=1).collect()} == got
        assert {r["doc_id"]: r["text"] for r in pii.redact(some, t, most=1).collect()}[10] == "zulu line [PHONE] stop"


def test_pii_finds_what_has_a_shape(spark):
    """Addresses without digits or @, numbers inside long unspaced runs and in groups, and contexts that only discovered instances support."""
    def cand(t):
        return {t[s:e] for s, e in pii.unknown_tokens(t, pii.base_spans(t))}

    assert "john@localhost" in cand("mail john@localhost now") and "jane(at)example.com" in cand("or jane(at)example.com.")
    assert "jane at example dot com" in cand("or jane at example dot com") and not cand("look at this") and "fe80::a" in cand("host fe80::a up")
    run = "x," * 80 + "id=5550123;" + "y" * 120
    assert "5550123" in cand(run) and "12 34 56 78" in cand("call 12 34 56 78 today")
    assert cand("电话" * 60 + "5550199" + "。" * 9) == {"5550199"}

    rows = [(i, f"{prose(4, i)} write kilo a{i}@x{i}.org stop") for i in range(30)]
    rows += [(100 + i, f"{prose(4, i)} write kilo {n}@localhost stop") for i, n in enumerate(("ann", "bob", "cid"))]
    rows += [(200 + i, f"{prose(4, i)} under lima {n}@localhost end") for i, n in enumerate(("ann", "bob", "cid"))]
    rows += [(300 + i, "联" * 90 + f"号码:+1 555 0{i:03d}22 止") for i in range(30)] + [(400, "络" * 120 + "号码:5550199。" + "络" * 120)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    trusted = pii.bootstrap(docs)
    assert trusted.get("l2 write kilo") == "email" and trusted.get("l2 under lima") == "email"
    got = {r["doc_id"]: r for r in pii.extract(docs, trusted).collect()}
    for i, n in ((101, "bob@localhost"), (201, "bob@localhost")):
        at = rows[[r[0] for r in rows].index(i)][1].index(n)
        assert got[i]["spans"] == f"email:{at}:{at + len(n)}" and got[i]["n_email"] == 0
    assert got[400]["spans"] == "phone:123:130"


def test_pii_equals_a_plain_bootstrap(spark):
    """Trusted patterns and all spans against the same rules in plain Python; words that stand everywhere are not trusted however pure their instances are."""
    r = random.Random(6)
    rows = [(i, f"{prose(6, i)} write kilo a{i % 20}@x{i % 20}.org stop") for i in range(30)] + [(50 + i, f"{prose(6, i)} write kilo {n}@localhost stop") for i, n in enumerate(("ann", "bob", "cid"))]
    rows += [(100 + i, f"{prose(6, i)} under lima {n}@localhost end") for i, n in enumerate(("ann", "bob", "cid"))]
    rows += [(200 + i, f"{prose(9, i)} the +1 555 0{i:03d}22 {prose(3, i)} the the {prose(5, i)}") for i in range(12)] + [(300, "the 5550199 now"), (301, None), (302, "write kilo zoe@localhost stop"), (303, f"{prose(4, 1)} dial=+1 555 0777 01 x")]
    rows += [(400 + i, f"host is 10.0.{i}.{r.randrange(256)} ok, host is v{i}.{i}00.x ok") for i in range(6)] + rows[:3]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3, "text")
    graph, stands = collections.Counter(), collections.Counter()
    for _, t in rows:
        base = pii.base_spans(t)
        for k, s, e in [*base, *((None, s, e) for s, e in pii.unknown_tokens(t or "", base))]:
            graph.update((p, t[s:e].lower(), k, 15 if k is not None else pii._can_be(t[s:e])) for p in pii.patterns(t, s, e))
        w = [x.lower().strip(".,;:!?\"'()[]{}") or x for x in (t or "").split()]
        stands.update([*(f"l1 {a}" for a in w), *(f"l2 {a} {b}" for a, b in zip(w, w[1:])), *(f"lr {a} {b}" for a, b in zip(w, w[2:]))])
    found, before = {}, None
    while True:
        score = {}
        for p in {g[0] for g in graph}:
            mine = [(i, k, can, n) for (q, i, k, can), n in graph.items() if q == p]
            for kind in range(4):
                sure = [(n, 1.0) for _, k, _, n in mine if k == kind] + [(n, found[i, kind]) for i, k, _, n in mine if k is None and (i, kind) in found]
                total = max(sum(n for _, _, can, n in mine if can >> kind & 1), stands[p] if p[:3] in ("l1 ", "l2 ", "lr ") else 0)
                if sum(c >= pii.MIN_CONFIDENCE for _, c in sure) >= pii.MIN_SEEDS and sum(n * c for n, c in sure) >= pii.MIN_CONFIDENCE * total:
                    score[p, kind] = sum(n * c for n, c in sure) / total
        miss = collections.defaultdict(lambda: 1.0)
        for p, i, k, can in graph:
            for kind in range(4):
                if k is None and can >> kind & 1 and (p, kind) in score:
                    miss[i, kind] *= 1 - min(score[p, kind], 0.999999)
        found = {x: 1 - m for x, m in miss.items()}
        now = (len(score), len(found), sum(score.values()))
        if before and now[:2] == before[:2] and now[2] - before[2] <= 1e-6:
            break
        before = now
    best = {}
    for (p, kind), c in sorted(score.items(), key=lambda x: (-x[1], pii.KINDS[x[0][1]])):
        best.setdefault(p, pii.KINDS[kind])
    trusted = pii.bootstrap(docs, most=2)
    assert dict(trusted) == best and "l1 the" not in best and best["l2 write kilo"] == best["l2 under lima"] == "email"
    want = collections.Counter((i, ",".join(f"{pii.KINDS[k]}:{s}:{e}" for k, s, e in sorted(sum(pii.all_spans(t, best), [])))) for i, t in rows)
    got = pii.extract(docs, trusted).collect()
    assert collections.Counter((x["doc_id"], x["spans"]) for x in got) == want and sum(x["n_added"] for x in got) >= 4
    assert all(x["n_spans"] == len([y for y in x["spans"].split(",") if y]) for x in got)


def test_maxent_counts_and_base(spark):
    texts = [(i, prose(30 + i % 50, i % 90)) for i in range(200)] + [(200, None), (201, ""), (None, "q q"), (3, prose(33, 3)), (3, prose(33, 3))]
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    got = maxent.language_model_scores(docs).collect()
    held = lambda i: zlib.crc32(b"" if i is None else str(i).encode()) % 10 == 0
    c = collections.Counter()
    for i, t in texts:
        if not held(i):
            c.update([*(t or "").lower().split(), None])
    n, v = sum(c.values()), len(c)
    want = collections.Counter()
    for i, t in texts:
        w = [*(t or "").lower().split(), None]
        want[i, held(i), len(w), sum(c[x] > 0 for x in w), n, round(sum(np.log10((c[x] + 0.1) / (n + 0.1 * (v + 1))) for x in w), 6)] += 1
    assert collections.Counter((r["doc_id"], r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"], round(r["base_score"], 6)) for r in got) == want
    assert sum(r["score"] for r in got) > sum(r["base_score"] for r in got)
    assert maxent.language_model_scores(docs.limit(0)).count() == 0


def test_maxent_words_are_the_most_frequent(spark, monkeypatch):
    """All words of the counts above the edge, those of least hash at it; as many as there are where they are few."""
    r = np.random.default_rng(3)
    h = np.unique(r.integers(-(2**63), 2**63 - 1, 30_000))
    c = np.maximum(1, 40_000 // (1 + np.arange(len(h))))
    counts = spark.createDataFrame(list(zip(h.tolist(), c.tolist())), "h long, c long").repartition(9)
    for most in (5, 300, 5000, 10**6):
        monkeypatch.setattr(maxent, "WORDS", most)
        m = maxent.prepare(counts)
        rank = sorted(zip((-np.floor(8 * np.log2(c))).tolist(), h.tolist(), c.tolist()))[:most]
        assert sorted(m.words.h.view(np.int64).tolist()) == sorted(x for _, x, _ in rank) and sorted(m.c.tolist()) == sorted(n for _, _, n in rank)
        assert (m.total, m.distinct) == (c.sum(), len(h)) and (np.diff(m.c) <= 0).all()
        got = m.words.find(np.append(m.words.h[::7], np.uint64(12345)))
        assert got[:-1].tolist() == list(range(0, len(m.c), 7)) and got[-1] == -1


def test_maxent_scores_equal_brute_force(spark, odd, monkeypatch):
    """Every position trains; scores equal the plain formula, sum to 1 over all words and do not depend on partitions."""
    monkeypatch.setattr(maxent, "WORDS", 60)
    monkeypatch.setattr(maxent, "FLUSH", 700)
    rows = [(i, prose(60, i % 17) + f" only{i}") for i in range(80)] + [(200, None), (201, ""), (202, "x" * 9000), (None, "w1 w2"), (3, "w1")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    model = maxent.train(docs, maxent.prepare(maxent.token_counts(docs, "text", "doc_id")), "text", "doc_id")
    learn = [t for i, t in rows if not maxent.held_out(i)]
    h, ends = maxent.tokens(learn)
    cls, feature = model.features(h, model.words.find(h), ends)
    assert model.w[feature.ravel()].any(axis=1).all()
    first = model.w.copy()
    table = np.zeros((2, maxent.WIDTH, maxent.ROWS), np.int64)
    maxent.observed(model, table[0], h, ends)
    maxent.expected(model, table[1], h, ends)
    for r in feature:  # one position after the other
        for x, c in zip(r, cls):
            table[0, c, x] -= 1
        for x, q in zip(r, model.probabilities(feature)):
            table[1, :, x] -= np.rint(q * maxent.UNIT).astype(np.int64)
    assert not table[0].any() and abs(table[1]).max() <= len(h) and (first == model.w).all()

    words = lambda t: [*(t or "").lower().split(), None]
    c, pair, near = collections.Counter(), collections.Counter(), collections.Counter()
    for t in learn:
        w = words(t)
        c.update(w)
        pair.update(zip([True, *w], w))
        near.update([True, *w[:-1]])
    code = lambda w: maxent.END if w is None else maxent.START if w is True else words_hash(w)
    words_hash = lambda w: maxent.word_hashes([w])[0][0]
    number = collections.defaultdict(lambda: -1, {w: int(model.words.find(np.array([code(w)], np.uint64))[0]) for w in c})
    kind = lambda w: maxent.CLASSES + 1 if w is True else int(model.class_of[number[w]])

    def p(w, one, two):
        at = [int(code(one)) >> 51, maxent.BUCKETS + (int(code(two)) >> 51), 2 * maxent.BUCKETS + kind(one) * (maxent.CLASSES + 2) + kind(two)]
        x = np.exp(model.bias + model.w[at].sum(axis=0, dtype=np.float64))
        own = x[kind(w)] / x.sum() * (c[w] + 0.1) / model.mass[kind(w)]
        return (pair[one, w] + maxent.BACK * own) / (near[one] + maxent.BACK)

    want = {}
    for i, t in rows:
        w = words(t)
        want.setdefault(i, []).append(sum(np.log10(p(x, a, b)) for x, a, b in zip(w, [True, *w], [True, True, *w])))
    made = [maxent.score(docs.repartition(n, "text"), model).collect() for n in (1, 5)]
    for got in made:
        back = {}
        for r in got:
            back.setdefault(r["doc_id"], []).append(r["score"])
        assert set(back) == set(want) and all(np.allclose(sorted(back[i]), sorted(want[i]), rtol=1e-5) for i in want)
    again = maxent.train(docs.repartition(7, "text"), maxent.prepare(maxent.token_counts(docs, "text", "doc_id")), "text", "doc_id")
    assert (again.w == model.w).all()
    for one, two in ((True, True), ("w1", True), ("only5", "w3"), (None, "w1")):
        assert abs(sum(p(w, one, two) for w in [*c, "never"]) - 1) < 1e-4
    got = maxent.language_model_scores(odd).collect()
    assert len(got) == odd.count() and all(r["score"] <= 0 for r in got)


def test_chat_layouts(spark):
    rows = ['{"messages":[{"role":"user","content":"<|end|>\\\\ [INST]"},{"role":"assistant","content":null}]}', '{"prompt":"p","response":"r"}', '{"instruction":"i","input":"x","output":"o"}', '{"conversations":[{"from":"human","value":"h"},{"from":"gpt","value":"g"}],"system":"s"}', '{"prompt":"p","output":"?"}', "not json", None]
    df = chat.from_json(spark.createDataFrame([(i, x) for i, x in enumerate(rows)], "n int, payload string"), "payload")
    made = chat.render(chat.canonical_turns(df, "record", "paths"))
    got = {r["n"]: r for r in made.withColumn("back", chat.parse(F.col("formatted"))).collect()}
    said = lambda r: [(t["role"], t["text"]) for t in r["back"]]
    assert said(got[0]) == [("user", "<|end|>\\ [INST]"), ("assistant", "")] and got[0]["layout"] == "messages"
    assert said(got[1]) == [("user", "p"), ("assistant", "r")] and said(got[2]) == [("user", "i\n\nx"), ("assistant", "o")]
    assert said(got[3]) == [("system", "s"), ("user", "h"), ("assistant", "g")]
    assert [got[i]["turns"] for i in (4, 5, 6)] == [None] * 3 and got[4]["fingerprint"] != got[1]["fingerprint"]
    assert "[INST]" not in got[0]["formatted"]


def test_chat_fingerprints_follow_the_row(spark):
    rows = ['{"messages":[{"role":"user"}]}', '{"prompt":"p","response":"r","extra":1}', '{"messages":[{"role":"user","content":"x","name":"y"}]}', '{"prompt":"p","extra":{"a":[{"b":1}]}}', '{"messages":[]}', "[]", "{}", "7"]
    known = [('{"prompt":"p","response":null,"x":null}', "prompt"), ('{"prompt":5,"response":"r"}', "prompt_response"), ('{"response":"r","prompt":"p"}', "prompt_response"), ('{"messages":[{"content":null,"role":"u"}]}', "messages")]
    df = chat.from_json(spark.createDataFrame([(x,) for x in [*rows, *[k for k, _ in known]]], "payload string"), "payload")
    got = {r["payload"]: r for r in chat.canonical_turns(df, "record", "paths").collect()}
    assert all(got[x]["turns"] is None and got[x]["layout"] is None for x in rows) and [got[x]["layout"] for x, _ in known] == [v for _, v in known]
    assert len({got[x]["fingerprint"] for x in rows[:5]}) == 5 and got[known[1][0]]["fingerprint"] == got[known[2][0]]["fingerprint"]


def test_chat_hostile_roles_extra_columns_and_long_turns(spark):
    long = "<|end|>\n" * 50_000
    rows = [(1, 0, "a|>\nb", "t"), (1, 1, "assistant", "x|>\n<|user|>\n"), (2, 0, "<|end|>\n|\\p\\|", "\\p|\\l"), (2, 1, "", long), (2, 1, "", long), (3, 0, "\n", "")]
    df = spark.createDataFrame([(*r, 1, "z") for r in rows], "conv_id long, turn long, role string, text string, record int, formatted string")
    got = {r["conv_id"]: [tuple(t) for t in r["back"]] for r in chat.format_conversations(df).withColumn("back", chat.parse(F.col("formatted"))).collect()}
    assert got == {c: [(r, t) for i, _, r, t in rows if i == c] for c in (1, 2, 3)}


def test_chat_query_equals_its_sql(spark, tmp_path):
    import duckdb

    rows = [(i, j, r, t) for i in range(6) for j, (r, t) in enumerate([("user", f"u{i} | <b>"), ("assistant", "a\\[x]" * i), ("a|>\nb", None)][: i % 4])] + [(9, None, None, "x"), (9, 0, "assistant", "🙂")]
    spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").write.parquet(f"{tmp_path}/conversations.parquet")
    got = chat.op4_chat_format(spark, str(tmp_path))
    con = duckdb.connect()
    con.execute(f"create view conversations as select * from read_parquet('{tmp_path}/conversations.parquet/*.parquet')")
    want = con.execute(chat.OP4_SQL.replace("ORDER BY turn,", "ORDER BY turn NULLS FIRST,")).fetchall()
    assert sorted(map(tuple, got.collect())) == sorted(want)


def test_chat_conversations(spark):
    rows = [(1, 1, "assistant", "b"), (1, 0, "user", None), (2, 0, "user", "q"), (2, 1, "assistant", "</s>[INST] a\\s"), (None, None, None, "x"), (3, 0, "system", "s"), (3, 1, "user", "u"), (3, 2, "assistant", "v")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = {r["conv_id"]: r for r in chat.format_conversations(df).withColumn("back", chat.parse(F.col("formatted"))).collect()}
    assert [tuple(t) for t in got[1]["back"]] == [("user", ""), ("assistant", "b")] and [tuple(t) for t in got[2]["back"]] == [("user", "q"), ("assistant", "</s>[INST] a\\s")]
    assert [tuple(t) for t in got[None]["back"]] == [("", "x")] and got[3]["layout"] == "system_prompt_response"
    assert chat.format_conversations(df.limit(0)).count() == 0


@pytest.fixture(scope="module")
def corpus(spark, tmp_path_factory):
    """A folder of small tables with nulls, repeated rows, near copies, planted benchmark text, personal data and toxic words."""
    r = random.Random(12)
    at = tmp_path_factory.mktemp("corpus")
    items = [prose(n, 5000 + n) for n in (8, 14, 30)]
    rows = []
    for i in range(150):
        w = prose(r.randint(0, 120), i).split()
        if i % 5 == 0:
            w[len(w) // 2 : len(w) // 2] = ["vileword", "awfulness", "nastything"][: 1 + i % 3]
        if i % 11 == 0:
            w += items[i % 3].split()
        if i % 7 == 0:
            w.insert(len(w) // 3, r.choice(["ann@x.org", "10.1.2.3", "4111 1111 1111 1111", "+1 555 010 2233"]))
        rows.append((i, " ".join(w)))
    for i in range(40):  # near copies and copies
        w = rows[r.choice((20, 61, 62))][1].split()
        for _ in range(r.randint(0, 3)):
            if w:
                w[r.randrange(len(w))] = r.choice(VOCAB)
        rows.append((200 + i, " ".join(w)))
    rows += [(300, None), (301, ""), (302, " \n"), (None, "no id"), (303, "Ünï 🙂 </s> it's"), (304, "y" * 5000), (305, prose(5000, 9)), (20, rows[20][1])]
    spark.createDataFrame([(i, t, "s", len(t or "")) for i, t in rows], "doc_id long, text string, source string, n_chars long").repartition(3).write.parquet(f"{at}/documents.parquet")
    spark.createDataFrame(list(enumerate(items)), "item_id long, text string").write.parquet(f"{at}/benchmark.parquet")
    spark.createDataFrame([(i, 1, int(i % 5 == 0)) for i in range(0, 150, 2)], "doc_id long, quality int, toxic int").write.parquet(f"{at}/labels.parquet")
    return str(at), rows, items


def _shingles(text, k):
    w = (text or "").encode().lower().split()
    return {tuple(w[i : i + k]) for i in range(max(1, len(w) - k + 1))} if w else set()


def test_each_query_keeps_its_contract(spark, corpus):
    import sentencepiece
    import tokenizers

    at, rows, items = corpus
    many = lambda f: collections.Counter((i, *f(t or "")) for i, t in rows)
    got = lambda op, *names: collections.Counter(tuple(r[n] for n in ("doc_id", *names)) for r in op(spark, at).collect())
    sha = lambda x: hashlib.sha256(x.encode()).hexdigest()

    found = {(r["doc_id"], r["item_id"]) for r in decontaminate.op1_decontaminate(spark, at).collect()}
    h = {k: words.word_hashes([t], strip=True)[0] for k, t in enumerate(items)}
    want = set()
    for i, t in rows:
        w = words.word_hashes([t], strip=True)[0]
        want |= {(i, k) for k, x in h.items() if any(decontaminate._run(w, x, d)[2] >= decontaminate._need(x) for d in range(-len(x), len(w)) if min(len(x), len(w) - d) > max(0, -d))}
    assert found == want and len(want) >= 10

    toxic = {r["doc_id"]: r["toxic"] for r in toxicity.op2_toxicity(spark, at).collect()}
    assert len(toxic) == len({i for i, _ in rows}) and all(isinstance(x, bool) for x in toxic.values())

    fast = tokenizers.Tokenizer.from_file(BPE)
    ids = lambda t: fast.encode(t, add_special_tokens=False).ids
    assert got(bpe.op3_bpe, "n_tokens", "ids_sha256", "decoded_sha256") == many(lambda t: (len(x := ids(t)), sha(" ".join(map(str, x))), sha(fast.decode(x, skip_special_tokens=False))))

    known = collections.Counter(w for i, t in rows if not maxent.held_out(i) for w in [*(t or "").encode().lower().split(), None])
    n, z = sum(known.values()), sum(known.values()) + 0.1 * (len(known) + 1)
    said = lambda t: [*t.encode().lower().split(), None]
    lm = {}
    for r in maxent.op5_maxent(spark, at).collect():
        lm[r["doc_id"]] = r
    for i, t in rows:
        w = said(t or "")
        r = lm[i]
        assert (r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"]) == (maxent.held_out(i), len(w), sum(known[x] > 0 for x in w), n)
        assert abs(r["base_score"] - sum(np.log10((known[x] + 0.1) / z) for x in w)) < 1e-9 * len(w) + 1e-9 and r["score"] < 0

    # rows that repeat an id are one document
    sets = {i: _shingles(t, 3) for i, t in rows if i is not None}
    order = sorted(sets)
    comp = dict(zip(order, (order[c] for c in links([sets[i] for i in order], 90))))
    assert got(shingle_join.op6_shingle_join, "n_shingles", "component_id") == collections.Counter((i, len(_shingles(t, 3)), comp.get(i)) for i, t in rows)

    import duckdb

    con = duckdb.connect()
    con.execute(f"create view documents as select * from read_parquet('{at}/documents.parquet/*.parquet')")
    assert collections.Counter(con.execute(shingle_join.OP6_SQL).fetchall()) == collections.Counter((i, len(_shingles(t, 3)), comp.get(i)) for i, t in rows)

    def base(t):
        spans = sorted(slow_spans(t))
        return (*[sum(k == j for k, _, _ in spans) for j in range(4)], sha(",".join(f"{pii.KINDS[k]}:{a}:{b}" for k, a, b in spans)))

    assert got(pii.op7_pii, "n_email", "n_ip", "n_card", "n_phone", "base_sha256") == many(base)

    pieces = sentencepiece.SentencePieceProcessor(model_file=P.path("piece_bpe_32k.model"))
    assert got(token_counts.op8_token_counts, "n_bytes", "n_tokens", "over_limit") == many(lambda t: (len(t.encode()), m := len(pieces.encode(t)), m > 4096))
    assert len(pieces.encode(prose(5000, 9))) > 4096

    crc = lambda t: (len(x := [*ids(t), 1]), zlib.crc32(np.array(x, "<u4").tobytes()))
    files = simple8b.op9_simple8b(spark, at).collect()
    assert collections.Counter((r["doc_id"], r["n_tokens"], r["ids_crc32"]) for r in files) == many(crc)
    starts = sorted((r["start"], r["n_tokens"], r["doc_id"]) for r in files)
    assert [s for s, _, _ in starts] == [0, *np.cumsum([m for _, m, _ in starts])[:-1].tolist()] and [i for _, _, i in starts] == sorted((i for _, _, i in starts), key=lambda i: (i is not None, i))

    full = lambda t: (raw := t.encode()) + b" " * (-len(raw) % 192 if raw else 192)
    assert got(tiff.op10_tiff_media, "n_bytes", "payload_bytes", "payload_sha256", "tail_crc32") == many(lambda t: (len(t.encode()), len(p := full(t)), hashlib.sha256(p).hexdigest(), zlib.crc32(p[-16:])))


def test_pipeline_equals_plain_stages(spark, corpus):
    """run() against the same rules row by row: the model's formula, brute-force links, every diagonal, plain redaction, the library's ids."""
    import corpus_pipeline
    import tokenizers

    at, rows, items = corpus
    docs = spark.read.parquet(f"{at}/documents.parquet")
    model = toxicity.train(docs, spark.read.parquet(f"{at}/labels.parquet"))
    memo = toxicity._Memo(model.place)
    sig = lambda x: 1 / (1 + np.exp(-x))
    bad = lambda t: sig(sum(model.values[f] for f in toxicity.text_features(t, memo)) - model.cuts[0]) >= 0.5
    left = [(i, t) for i, t in rows if not bad(t)]
    assert 10 < len(rows) - len(left) < 100
    sets = {i: _shingles(t, 5) for i, t in left if i is not None}
    order = sorted(sets)
    comp = dict(zip(order, (order[c] for c in links([sets[i] for i in order], 80))))
    kept = [(i, t) for i, t in left if i is None or comp[i] == i]
    assert len(kept) < len(left)
    h = [words.word_hashes([t], strip=True)[0] for t in items]

    def leak(t):
        w = words.word_hashes([t], strip=True)[0]
        return any(decontaminate._run(w, x, d)[2] >= decontaminate._need(x) for x in h for d in range(-len(x), len(w)) if min(len(x), len(w) - d) > max(0, -d))

    clean = [(i, t) for i, t in kept if not leak(t)]
    assert len(clean) < len(kept)
    trusted = dict(pii.bootstrap(spark.createDataFrame(clean, "doc_id long, text string")))
    fast = tokenizers.Tokenizer.from_file(BPE)
    want = collections.Counter((i, tuple(fast.encode(pii.redacted(t, trusted) or "", add_special_tokens=False).ids)) for i, t in clean)
    made = corpus_pipeline.run(spark, at).collect()
    assert collections.Counter((r["doc_id"], tuple(r["ids"])) for r in made) == want and all(r["n_tokens"] == len(r["ids"]) for r in made)
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "near_duplicates", "decontamination", "pii", "bpe"]


def test_pipeline_stages(spark, tmp_path, odd, none):
    import corpus_pipeline

    spark.createDataFrame([(1, 1, 0)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([(1, prose(30, 77))], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    for docs in (odd, none):
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, docs, str(tmp_path))
            assert name == "bpe" or out.schema.simpleString() == docs.schema.simpleString()
            assert (out.count() > 0) == (docs is odd)
