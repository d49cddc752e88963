"""Every operator against a plain computation on a small table of awkward rows."""

import hashlib
import itertools
import json
import math
import random
import re
import struct
import textwrap
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from layerforge.llm import (chat_tools, chunk_bpe, crf_quality, curve_pack, exact_topk, license_rules, pca_near,
                            simhash_cover, suffix_dedup, token_files)
from layerforge.llm.common import new_path, tokenizer_path
from layerforge.llm.queries import ORACLE, QUERIES
from layerforge.llm.units import load_tokenizer, unit_encoder
from layerforge.session import ship_package

BYTE, WORD = tokenizer_path("byte_bpe_50k.json"), tokenizer_path("word_bpe_49k.json")


def _words(rng, n):
    return " ".join("".join(rng.choice(["an", "the", "er", "Ñé", "tion", "ou"]) for _ in range(rng.randint(1, 4))) for _ in range(n))


def _rows():
    """(doc_id, text): nulls, empty and odd texts, near and exact copies, repeated rows, one long text."""
    rng = random.Random(5)
    passage = _words(rng, 120)
    rows = [(1, None), (2, ""), (3, " \n\t "), (4, "a"), (None, "no id here"), (None, None),
            (5, "x" * 2500), (6, "na " * 700), (7, "don't <|endoftext|> x<|endoftext|>  y  \n\n z"), (8, "日本語" * 300)]
    for i in range(10, 40):
        rows.append((i, f"{_words(rng, rng.randint(3, 90))}. {passage if i % 3 == 0 else ''}\n{_words(rng, 60)}"))
    base = rows[-1][1]
    rows += [(50, base), (51, base + " end"), (52, base.replace("the", "THE", 1)), (39, base), (39, base)]
    rows.append((60, "\n".join(_words(rng, 40) for _ in range(300)) + "\n" + passage))
    return rows


ROWS = _rows()


@pytest.fixture(scope="module")
def docs(spark):
    ship_package(spark)
    plain = spark.createDataFrame(ROWS, "doc_id long, text string")
    # other columns with the names that the operators use inside
    return plain.select("*", *[F.lit(7).alias(c) for c in ("row", "h", "key", "raw", "s", "z", "mark", "score", "ids", "n_chars", "own_id")]).repartition(3)


@pytest.fixture(scope="module")
def empty(docs):
    return docs.limit(0)


def _ids(path, text):
    return load_tokenizer(path).encode(text or "", add_special_tokens=False).ids


def _crc(ids):
    return zlib.crc32(struct.pack(f"<{len(ids)}I", *ids))


def _same(found, wanted):
    assert Counter(map(tuple, found)) == Counter(wanted)


@pytest.mark.parametrize("kind,path", [("byte", BYTE), ("word", WORD)])
def test_units_equal_the_library(kind, path):
    rng = random.Random(2)
    parts = ["a", " ", "\n", "don't", "'re", "<|endoftext|>", "<|ENDOFTEXT|>", "é", "é", "日", "  ", "12", ".", "\t", " ",
             "\x1c", "WORD", "ß", "İ", "ſ", "%%%", "\r\n", "　"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 40))) for _ in range(1500)]
    enc = unit_encoder(path, kind)
    assert enc.encode(texts) == [np.array(_ids(path, t), enc.dtype).tobytes() for t in texts]


def test_units_stay_within_their_bound():
    enc = type(unit_encoder(BYTE, "byte"))(load_tokenizer(BYTE), max_units=20)
    texts = [" ".join(f"w{i}x{j}" for j in range(9)) for i in range(30)]
    assert enc.encode(texts) == [np.array(_ids(BYTE, t), enc.dtype).tobytes() for t in texts]
    assert sum(map(len, enc.caches)) <= 20


def _digests(text):
    ids = _ids(BYTE, text)
    decoded = load_tokenizer(BYTE).decode(ids, skip_special_tokens=False)
    return len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(decoded.encode()).hexdigest()


def test_chunk_bpe(docs, empty):
    _same(chunk_bpe.encode_documents(docs, BYTE, chunk_bpe.digests).collect(), [(d, *_digests(t)) for d, t in ROWS])
    assert chunk_bpe.encode_documents(empty, BYTE).collect() == []
    round_trip = chunk_bpe.decode_documents(chunk_bpe.encode_documents(docs, BYTE), BYTE)
    _same(round_trip.collect(), [(d, t or "") for d, t in ROWS])


def test_chunk_joins_are_repaired(monkeypatch):
    monkeypatch.setattr(chunk_bpe, "LEAST", 8)
    monkeypatch.setattr(chunk_bpe, "MOST", 24)
    rng, enc = random.Random(1), unit_encoder(BYTE, "byte")
    parts = ["a", " ", "\n", "don't", "'re", "<|endoftext|>", "é", "日本", "  ", "12", ".", "x" * 30]
    trimmed = 0
    for _ in range(300):
        text = "".join(rng.choice(parts) for _ in range(100))
        out = b""
        for h, head, tail, ids, chunk in chunk_bpe.pieces_of(text, lambda h: rng.random() < 0.7, enc.one, 2):
            own = enc.one(chunk.decode()) if h else ids
            out += own[2 * head:len(own) - 2 * tail]
            trimmed += head + tail > 0
        assert out == np.array(_ids(BYTE, text), "<u2").tobytes()
    assert trimmed > 100


def test_chunks_follow_content():
    rng = random.Random(4)
    shared = _words(rng, 3000)
    a, b = (set(chunk_bpe.chunks_of(_words(rng, n) + " " + shared)) for n in (50, 333))
    assert len(a & b) >= 0.7 * len(chunk_bpe.chunks_of(shared))
    assert b"".join(chunk_bpe.chunks_of(shared)).decode() == shared


def _brute_repeats(texts, length):
    seen = Counter(t[i:i + length] for t in texts for i in range(len(t) - length + 1))
    out = []
    for t in texts:
        gone = bytearray(len(t))
        for i in range(len(t) - length + 1):
            if seen[t[i:i + length]] > 1:
                gone[i:i + length] = b"\1" * length
        runs = sum(1 for i, x in enumerate(gone) if x and (i == 0 or not gone[i - 1]))
        out.append((len(t), sum(gone), runs, bytes(c for c, x in zip(t, gone) if not x)))
    return out


@pytest.mark.parametrize("length,hot", [(400, 8192), (400, 1), (64, 3)])
def test_suffix_dedup(docs, length, hot):
    raw = [(t or "").encode() for _, t in ROWS]
    wanted = [(d, n, gone, runs, hashlib.sha256(kept).hexdigest())
              for (d, _), (n, gone, runs, kept) in zip(ROWS, _brute_repeats(raw, length))]
    _same(suffix_dedup.repeats_report(docs, length, hot).collect(), wanted)


def test_suffix_dedup_keeps_columns(docs, empty):
    raw = [(t or "").encode() for _, t in ROWS]
    wanted = [(d, None if t is None else kept.decode("utf-8", "ignore"))
              for (d, t), (_, _, _, kept) in zip(ROWS, _brute_repeats(raw, 400))]
    out = suffix_dedup.remove_repeats(docs)
    assert out.schema == docs.schema
    _same(out.select("doc_id", "text").collect(), wanted)
    assert out.where("text IS NOT NULL AND n_chars <> length(text)").isEmpty()
    assert suffix_dedup.remove_repeats(empty).collect() == [] == suffix_dedup.repeats_report(empty).collect()


def test_induced_sorting_spills_and_agrees():
    rng = random.Random(3)
    from layerforge.llm.induced_sort import suffix_order

    for _ in range(200):
        text = [rng.randint(1, rng.choice([1, 2, 4])) for _ in range(rng.randint(1, 60))] * rng.randint(1, 4)
        order, common = suffix_order(np.array(text, np.uint16), 1000, memory=rng.choice([64, 1 << 20]))
        wanted = sorted(range(len(text)), key=lambda i: text[i:])
        prefix = [0] + [sum(1 for _ in itertools.takewhile(lambda p: p[0] == p[1], zip(text[a:], text[b:])))
                        for a, b in zip(wanted, wanted[1:])]
        assert order.tolist() == wanted and common.tolist() == prefix


def test_curve_packing(docs, empty):
    pieces = curve_pack.pack_documents(docs.where("doc_id IS NOT NULL AND doc_id NOT IN (39)"), WORD).collect()
    by_doc, by_seq = defaultdict(list), defaultdict(list)
    for p in pieces:
        by_doc[p.doc_id].append(p)
        by_seq[p.sequence_id].append(p)
    texts = {d: t for d, t in ROWS if d is not None and d != 39}
    assert set(by_doc) == set(texts)
    for d, t in texts.items():
        ids, at = _ids(WORD, t) + [1], 0
        for p in sorted(by_doc[d], key=lambda p: p.start):
            assert (p.start, p.doc_tokens, p.ids_crc32) == (at, len(ids), _crc(ids[at:at + p.length]))
            at += p.length
        assert at == len(ids)
    for own in by_seq.values():
        at = 0
        for p in sorted(own, key=lambda p: p.offset):
            assert p.offset == at
            at += p.length
        assert at <= 2048 and at & (at - 1) == 0
    total = sum(len(_ids(WORD, t)) + 1 for _, t in ROWS)
    assert curve_pack.pack_documents(docs, WORD).agg(F.sum("length")).head()[0] == total
    assert curve_pack.pack_documents(empty, WORD).collect() == []


def test_hilbert_keys_walk_the_grid():
    side = 8
    cells = np.array(list(itertools.product(range(side), repeat=3)))
    keys = curve_pack.hilbert_keys(cells, 3)
    path = cells[np.argsort(keys)]
    assert sorted(keys.tolist()) == list(range(side ** 3))
    assert (np.abs(np.diff(path, axis=0)).sum(axis=1) == 1).all()


def _vectors():
    rng = np.random.default_rng(8)
    base = rng.normal(size=(120, 12))
    rows = [(i, x.tolist()) for i, x in enumerate(base)]
    rows += [(200 + i, (base[i % 5] + 0.05 * rng.normal(size=12)).tolist()) for i in range(80)]
    rows += [(300, base[0].tolist()), (301, (3 * base[0]).tolist()), (302, None), (303, [0.0] * 12), (304, [1.0] * 11 + [float("nan")]),
             (305, [1.0] * 11 + [None]), (306, [float("inf")] + [1.0] * 11), (350, base[1].tolist()[:7]), (351, [])]
    return rows


VECTORS = _vectors()


def _able(v):
    return v is not None and all(x is not None and np.isfinite(x) for x in v)


@pytest.fixture(scope="module")
def vectors(spark):
    ship_package(spark)
    return spark.createDataFrame(VECTORS, "vec_id long, embedding array<float>").withColumn("cls", F.lit(1)).repartition(3)


def test_exact_topk(vectors):
    used = [(i, [int(np.floor(256 * float(np.float32(x)))) for x in v]) for i, v in VECTORS if i is not None and _able(v)]
    wanted = []
    for q in sorted({i for i, _ in used if i % 50 == 0}):
        ranked = sorted((-sum(a * b for a, b in zip(w, v)), c) for i, w in used if i == q for c, v in used if c != q)[:5]
        wanted += [(q, k + 1, c, -s) for k, (s, c) in enumerate(ranked)]
    run = lambda **kw: exact_topk.exact_topk(vectors, F.col("vec_id") % 50 == 0, **kw).collect()
    _same(run(), wanted)
    _same(run(block=16, query_block=2), wanted)
    assert exact_topk.exact_topk(vectors.limit(0), F.col("vec_id") % 50 == 0).collect() == []


def test_topk_ties_repeats_and_large_values(spark):
    rows = [(50, [1.0, 0.0]), (1, [1.0]), (2, [1.0, 5.0]), (2, [1.0, 5.0]), (3, [2.0 ** 40]), (None, [9.0]), (4, [0.0, 1.0])]
    found = exact_topk.exact_topk(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), F.col("vec_id") % 50 == 0)
    _same(found.collect(), [(50, 1, 3, 256 * 2 ** 48), (50, 2, 1, 65536), (50, 3, 2, 65536), (50, 4, 2, 65536), (50, 5, 4, 0)])


def test_scores_are_the_same_in_every_number_type():
    rng = np.random.default_rng(1)
    for top in (100, 1 << 40, 1 << 62):
        q, c = rng.integers(-top, top, (5, 6)), rng.integers(-top, top, (9, 4))
        q[:, 1:3] = 0
        wanted = [[sum(int(a) * int(b) for a, b in zip(x, y)) for y in c] for x in q]
        assert exact_topk.scores(q, c).tolist() == wanted


def _brute_links(rows, cosine):
    able = [i for i, (_, v) in enumerate(rows) if _able(v) and any(v)]
    width = max(len(rows[i][1]) for i in able)
    m = np.zeros((len(able), width))
    for k, i in enumerate(able):
        m[k, :len(rows[i][1])] = np.float32(rows[i][1])
    m /= np.linalg.norm(m, axis=1, keepdims=True)
    linked = m @ m.T >= cosine
    root = list(range(len(able)))
    for _ in range(len(able)):
        root = [min([root[b] for b in np.flatnonzero(linked[a])] + [root[a]]) for a in range(len(able))]
    out = []
    for k, i in enumerate(able):
        first = min(rows[able[b]][0] for b in range(len(able)) if root[b] == root[k])
        out.append((rows[i][0], int(linked[k].sum()) - 1, first, rows[i][0] == first))
    return out + [(rows[i][0], 0, rows[i][0], True) for i in range(len(rows)) if i not in able]


@pytest.mark.parametrize("tile", [4096, 16])
def test_pca_near(vectors, tile):
    _same(pca_near.near_embeddings(vectors, tile=tile).collect(), _brute_links(VECTORS, 0.95))


def test_pca_near_cluster_of_near_copies(spark):
    rng = np.random.default_rng(8)
    center = rng.normal(size=12)
    far = rng.normal(size=(40, 12))
    near = center + rng.normal(scale=0.2, size=(3000, 12))
    m = np.concatenate([near, far])
    unit = m / np.linalg.norm(m, axis=1, keepdims=True)
    links = unit @ unit.T >= 0.95
    ids = rng.permutation(len(m))
    first = ids.copy()
    while (least := np.where(links, first, len(m)).min(axis=1)).tolist() != first.tolist():
        first = least
    wanted = [(int(i), int(n) - 1, int(f), bool(i == f)) for i, n, f in zip(ids, links.sum(axis=1), first)]
    rows = spark.createDataFrame([(int(i), v.tolist()) for i, v in zip(ids, m)], "vec_id long, embedding array<double>")
    _same(pca_near.near_embeddings(rows, tile=700).collect(), wanted)
    assert 0 < sum(w[1] for w in wanted) < 3000 * 3000


def test_forest_joins_what_is_linked_and_no_more():
    rng = np.random.default_rng(9)
    i, j = rng.integers(0, 6000, (2, 20000))
    i, j = i[i % 3 == j % 3], j[i % 3 == j % 3]
    forest = pca_near.Forest(6000)
    forest.join(i, j)
    again = pca_near.Forest(6000)
    again.join(*np.array(forest.edges).T)
    assert len(forest.edges) == 6000 - len(np.unique(forest.tree))
    same = {(a, b) for a, b in zip(forest.tree.tolist(), again.tree.tolist())}
    assert len(same) == len(np.unique(forest.tree)) == len(np.unique(again.tree))
    assert (forest.tree[i] == forest.tree[j]).all()


def test_pca_near_empty_and_idle(spark, vectors):
    assert pca_near.near_embeddings(vectors.limit(0)).collect() == []
    idle = spark.createDataFrame([(1, None), (None, [0.0])], "vec_id long, embedding array<float>")
    _same(pca_near.near_embeddings(idle).collect(), [(1, 0, 1, True), (None, 0, None, False)])


def test_token_files(spark, docs, empty):
    path = new_path(spark, "test-files")
    token_files.write_token_files(docs, path, BYTE)
    wanted, at = [], 0
    found = sorted(token_files.read_token_files(spark, path, BYTE, with_ids=True).collect(), key=lambda r: r.start)
    assert [r.doc_id for r in found] == sorted((d for d, _ in ROWS), key=lambda d: (d is not None, d or 0))
    left = Counter((d, tuple(_ids(BYTE, t) + [2])) for d, t in ROWS)
    for r in found:
        assert (r.start, r.n_tokens, r.ids_crc32) == (at, len(r.ids), _crc(r.ids))
        left[(r.doc_id, tuple(r.ids))] -= 1
        at += r.n_tokens
    assert set(left.values()) == {0}
    one = token_files.read_token_files(spark, path, BYTE, doc_ids=[60]).collect()
    assert [(r.doc_id, r.n_tokens) for r in one] == [(60, len(_ids(BYTE, dict(ROWS)[60])) + 1)]
    path = new_path(spark, "test-files")
    token_files.write_token_files(empty, path, BYTE)
    assert token_files.read_token_files(spark, path, BYTE).collect() == wanted


def _fingerprint(text):
    import xxhash

    words = re.findall("[^\x20\x09-\x0d]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return 0
    hashes = [xxhash.xxh64_intdigest(" ".join(words[i:i + 4]).encode(), 42) for i in range(max(1, len(words) - 3))]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def _brute_groups(marks, radius=4):
    names = sorted(set(marks))
    root = {m: m for m in names}
    for _ in names:
        new = {a: min(root[b] for b in names if bin(a ^ b).count("1") <= radius) for a in names}
        if new == root:
            break
        root = {a: min(root[a], root[new[a]]) for a in names}
    return root


@pytest.mark.parametrize("block", [1024, 2])
def test_simhash(docs, empty, block):
    marks = [_fingerprint(t) for _, t in ROWS]
    root = _brute_groups(marks)
    first = {r: min([d for (d, _), m in zip(ROWS, marks) if root[m] == r and d is not None], default=None) for r in set(root.values())}
    found = simhash_cover.simhash_groups(docs, block=block)
    _same(found.collect(), [(d, f"{m:016x}", first[root[m]]) for (d, _), m in zip(ROWS, marks)])
    assert simhash_cover.simhash_groups(empty).collect() == []
    if block == 1024:
        kept = simhash_cover.keep_one(docs)
        assert kept.columns == docs.columns
        assert sorted((r.doc_id is None, r.doc_id or 0) for r in kept.collect()) == sorted((d is None, d or 0) for d in first.values())


def test_masks_cover_every_pair():
    masks = [m & (1 << 64) - 1 for m in simhash_cover.covering_masks(4)]
    rng = random.Random(1)
    assert len(masks) == 31
    for _ in range(20_000):
        differ = sum(1 << i for i in rng.sample(range(64), rng.randint(0, 4)))
        assert any(m & differ == 0 for m in masks)


def test_large_buckets_keep_components(spark):
    rng = random.Random(6)
    base = rng.getrandbits(63)
    marks = sorted({base ^ (1 << rng.randrange(60)) ^ (1 << rng.randrange(60)) for _ in range(400)} | {rng.getrandbits(63) for _ in range(50)})
    links = simhash_cover.simhash_links(spark.createDataFrame([(m,) for m in marks], "mark long"), block=32).collect()
    root = _brute_groups(marks)
    assert all(bin(a ^ b).count("1") <= 4 for a, b in links)
    own = {m: m for m in marks}
    for _ in range(12):
        for a, b in links:
            own[a] = own[b] = min(own[a], own[b])
    assert own == root


CALLS = [  # conv_id, turn, call_id, after, name, arguments
    (1, 0, "a", None, "reply", '{"turn":1,"query":"hi","limit":3}'), (1, 2, "b", "a", "reply", '{"query":"x"}'),
    (1, 4, "c", "b", "reply", '{"turn":"1","query":"","more":1}'), (1, 4, "c", "b", "reply", '{"turn":"1","query":"","more":1}'),
    (1, 5, "d", "zz", "configure", '{"text":"t"}'), (1, 6, "e", "f", "configure", '{"text":"t"}'), (1, 7, "f", "e", "configure", '{"text":"t"}'),
    (2, 0, "a", None, "nothing", "{}"), (2, 1, "b", None, "reply", "[1]"), (2, 2, "g", None, "reply", "{bad"), (2, 3, "h", "b", "configure", None),
    (None, 0, "a", None, "configure", '{"text":"t"}'), (3, 0, None, None, "configure", '{"text":"t"}')]
RESULTS = [(1, "a", "z"), (1, "a", "y"), (1, "q", "lost"), (2, "a", None), (None, "a", "n"), (1, "d", "ok")]


def test_tool_calls(spark):
    calls = spark.createDataFrame(CALLS, "conv_id long, turn long, call_id string, after string, name string, arguments string")
    results = spark.createDataFrame(RESULTS, "conv_id long, call_id string, content string")
    rows = chat_tools.link_tool_calls(calls.withColumn("status", F.lit("x")), results.withColumn("level", F.lit(1)), chat_tools.CHAT_SCHEMAS)
    found = {(r.conv_id, r.call_id, r.status): r for r in rows.collect()}
    assert {k: r.level for k, r in found.items()} == {
        (1, "a", "ok"): 0, (1, "b", "invalid"): 1, (1, "c", "invalid"): 2, (1, "d", "invalid"): 0, (1, "e", "invalid"): None,
        (1, "f", "invalid"): None, (2, "a", "invalid"): 0, (2, "b", "invalid"): 0, (2, "g", "invalid"): 0, (2, "h", "invalid"): 1,
        (None, "a", "unnamed"): None, (3, None, "unnamed"): None, (1, "q", "orphan"): None}
    assert found[(1, "a", "ok")].json == ('{"after":null,"arguments":{"limit":3,"query":"hi","turn":1},"content":"y","errors":[],"id":"a",'
                                          '"level":0,"name":"reply","status":"ok"}')
    assert '"errors":["more is unexpected","query is under 1","turn is not BIGINT"]' in found[(1, "c", "invalid")].json
    assert '"errors":["turn is missing"]' in found[(1, "b", "invalid")].json
    assert '"errors":["follows a missing call"]' in found[(1, "d", "invalid")].json
    assert '"errors":["follows itself"]' in found[(1, "e", "invalid")].json
    assert '"errors":["not JSON"]' in found[(2, "g", "invalid")].json and '"errors":["not an object"]' in found[(2, "b", "invalid")].json
    assert chat_tools.link_tool_calls(calls.limit(0), results.limit(0), chat_tools.CHAT_SCHEMAS).collect() == []


def test_long_chains_of_calls(spark):
    n = 70
    calls = spark.createDataFrame([(1, i, f"k{i}", f"k{i - 1}" if i else None) for i in range(n)], "conv_id long, turn long, call_id string, after string")
    assert {r.call_id: r.level for r in chat_tools.call_levels(calls).collect()} == {f"k{i}": i for i in range(n)}


def test_crf_is_exact_on_small_chains():
    rng = np.random.default_rng(2)
    steps, emit = rng.normal(size=(2, 2)), rng.normal(size=(2, 4))
    lengths = np.array([4, 3])
    good, pairs, log_z = crf_quality.forward_backward(emit, lengths, steps)
    want_pairs = np.zeros((2, 2))
    for r, n in enumerate(lengths):
        total, marg, own = 0.0, np.zeros(n), np.zeros((2, 2))
        for ys in itertools.product((0, 1), repeat=int(n)):
            p = np.exp(sum(emit[r, k] for k in range(n) if ys[k]) + sum(steps[a, b] for a, b in zip(ys, ys[1:])))
            total += p
            marg += p * np.array(ys)
            for a, b in zip(ys, ys[1:]):
                own[a, b] += p
        assert np.allclose(good[r, :n], marg / total) and np.isclose(log_z[r], np.log(total))
        want_pairs += own / total
    assert np.allclose(pairs, want_pairs)


def test_quality_learns_and_bears_odd_rows(spark, docs, empty):
    rng = random.Random(9)
    rows = [(i, "\n".join(_words(rng, 12) + "." if i % 3 else _words(rng, 6).upper() + "!! ###" for _ in range(rng.randint(1, 8)))) for i in range(240)]
    table = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i % 3 > 0)) for i in range(240)] + [(None, 1), (5, None)], "doc_id long, quality int")
    field = crf_quality.train(table, labels)
    found = {r.doc_id: r for r in crf_quality.score_documents(table, field).collect()}
    held = [i for i in found if zlib.crc32(str(i).encode()) % 5 == 0]
    assert all(found[i].held_out == (i in held) and 0 <= found[i].score <= 1 for i in found)
    assert np.mean([found[i].predicted == int(i % 3 > 0) for i in held]) > 0.95
    odd = crf_quality.score_documents(docs, field).collect()
    assert Counter(r.doc_id for r in odd) == Counter(d for d, _ in ROWS) and all(r.score is not None for r in odd)
    kept = crf_quality.keep_good(docs, field)
    assert kept.schema == docs.schema and kept.count() == sum(r.predicted for r in odd)
    assert crf_quality.score_documents(empty, field).collect() == []
    none = crf_quality.train(docs, labels.limit(0))
    assert {r.score for r in crf_quality.score_documents(docs, none).collect()} == {0.5}


def test_held_out_rows_do_not_teach(spark):
    rows = [(i, "good words here." if i % 2 else "### BAD") for i in range(60)]
    table = spark.createDataFrame(rows, "doc_id long, text string")
    truth = [(i, i % 2) for i in range(60)]
    lies = [(i, q if zlib.crc32(str(i).encode()) % 5 else 1 - q) for i, q in truth]
    a, b = (crf_quality.train(table, spark.createDataFrame(x, "doc_id long, quality int")) for x in (truth, lies))
    assert np.array_equal(a.weights, b.weights) and np.array_equal(a.steps, b.steps)


def test_licences(spark, docs, empty):
    say = dict(license_rules.SENTENCES)
    texts = [
        (1, f"Some words. {say['MITShort']}\nMore."), (2, f"{say['MITGrant']} {say['MITNotice']}\n{say['MITWarranty']}"),
        (3, f"{say['BSDCondition']}\n{say['BSDSource']}\n{say['BSDBinary']}"), (4, f"{say['BSDSource']}\n{say['BSDCondition']}"),
        (5, f"{say['GPL3Short'].upper()}\n   {say['AllRights']}"), (6, "Licensed under the Apache License, Version 3.0."), (None, None),
        (7, f"{say['BSDCondition']}\n{say['BSDSource']}\n{say['BSDBinary']}\n{say['BSDNames']}"), (7, ""), (8, say["MPL"])]
    found = license_rules.scan_licences(spark.createDataFrame(texts, "doc_id long, text string")).collect()
    assert Counter((r.doc_id, r.licences, r.unmatched) for r in found) == Counter([
        (1, "MIT", ""), (2, "MIT", ""), (3, "BSD-2-Clause", ""), (4, "", "BSDSource,BSDCondition"), (5, "GPL-3.0", ""), (6, "", ""),
        (None, "", ""), (7, "BSD-3-Clause", ""), (7, "", ""), (8, "MPL-2.0", "")])
    assert license_rules.scan_licences(docs).count() == len(ROWS) and license_rules.scan_licences(empty).collect() == []


def test_wrapped_licences(spark):
    say = dict(license_rules.SENTENCES)
    wrap = lambda names, lead="", by="\n": by.join(
        "\n".join(lead + x for x in textwrap.wrap(say[n], 70)) for n in names.split())
    apache = textwrap.indent("""Licensed under the Apache License, Version 2.0 (the "License");
you may not use this file except in compliance with the License.
You may obtain a copy of the License at

    http://www.apache.org/licenses/LICENSE-2.0

Unless required by applicable law or agreed to in writing, software
distributed under the License is distributed on an "AS IS" BASIS,
WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.
See the License for the specific language governing permissions and
limitations under the License.""", "# ", lambda line: True)
    mit, bsd = "MITGrant MITNotice MITWarranty", "BSDCondition BSDSource BSDBinary BSDNames"
    texts = [(1, apache), (2, "Copyright 2020 A B\n" + apache.replace("# ", "")), (3, "/*\n" + apache.replace("#", " *") + "\n */\nint x;"),
             (4, apache.replace("# ", "dnl ").replace("\n", "\r\n")), (5, wrap(mit, "// ", "\n//\n")), (6, wrap(bsd, " * ")),
             (7, wrap("GPLFree GPLHope GPLSee", "REM ")), (8, "Released under\nthe MIT License\nRELEASED under the MIT License\nend"),
             (9, "Released under. \nThe MIT License."), (10, "Released under\nan MIT License"), (11, "x\n\x01Released\x01under the MIT License")]
    found = {r.doc_id: (r.licences, r.n_known, r.unmatched) for r in license_rules.scan_licences(
        spark.createDataFrame(texts, "doc_id long, text string")).collect()}
    assert found == {**{i: ("Apache-2.0", 4, "") for i in (1, 2, 3, 4)}, 5: ("MIT", 3, ""), 6: ("BSD-3-Clause", 4, ""),
                     7: ("GPL-3.0-or-later", 3, ""), 8: ("MIT", 2, ""), 9: ("", 0, ""), 10: ("", 0, ""), 11: ("MIT", 1, "")}


BSD2 = """Copyright (c) 2019, A. Writer
All rights reserved.

Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this
   list of conditions and the following disclaimer.
2. Redistributions in binary form must reproduce the above copyright notice,
   this list of conditions and the following disclaimer in the documentation
   and/or other materials provided with the distribution.

THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS"
AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE
IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE
DISCLAIMED."""


def test_headers_of_common_licences(spark, tmp_path):
    """Headers as they stand in source files; the engine and its SQL agree on all of them."""
    say = dict(license_rules.SENTENCES)
    wrap = lambda names, lead="": "\n".join(lead + x for n in names.split() for x in textwrap.wrap(say[n], 66))
    texts = [(1, BSD2, "BSD-2-Clause"), (2, "Copyright A. All rights reserved.", "Proprietary"), (3, "# SPDX-License-Identifier: MIT\nimport x", "MIT"),
             (4, "/* SPDX-License-Identifier: GPL-2.0-or-later */", "GPL-2.0-or-later"), (5, wrap("ISCGrant ISCWarranty", " * "), "ISC"),
             (6, wrap("LGPL21Free LGPLHope LGPLSee", "# "), "LGPL-2.1-or-later"), (7, wrap("AGPLFree GPLHope AGPLSee"), "AGPL-3.0-or-later"),
             (8, wrap("GPL2Free GPLHope GPLSee", "// "), "GPL-2.0-or-later"), (9, wrap("EPLTerms", " * "), "EPL-2.0"),
             (10, wrap("MPL MPLCopy", "; "), "MPL-2.0"), (11, wrap("BoostGrant"), "BSL-1.0"), (12, wrap("ZlibAsIs ZlibGrant"), "Zlib"),
             (13, wrap("LGPL3Free LGPLHope LGPLSee"), "LGPL-3.0-or-later"), (14, "SPDX-License-Identifier: Apache-2.0\nSPDX-License-Identifier: MIT", "Apache-2.0,MIT"),
             (15, wrap("MITGrant MITNotice MITWarranty", "REM ") + "\nAll rights reserved.", "MIT"), (16, "spdx-license-identifier:0BSD.", "")]
    df = spark.createDataFrame([t[:2] for t in texts], "doc_id long, text string")
    rows = license_rules.scan_licences(df).collect()
    assert {r.doc_id: r.licences for r in rows} == {i: name for i, _, name in texts}
    df.union(spark.createDataFrame([(20, None), (21, ""), (None, "Licensed under the MIT\n License. ")], "doc_id long, text string")).write.parquet(f"{tmp_path}/d")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{tmp_path}/d/*.parquet')")
    _same(license_rules.scan_licences(spark.read.parquet(f"{tmp_path}/d")).collect(), con.execute(ORACLE["op10_license_rules"]).fetchall())


def test_topk_keeps_different_vectors_of_one_id(spark, tmp_path):
    rng = np.random.default_rng(12)
    rows = [(int(i), rng.normal(size=4).tolist()) for i in [*range(1, 60), 50, 50, 100, 100, *[7] * 40, 8, 8]]
    rows += [rows[0], rows[20], rows[20], rows[49], rows[61]]  # the same vector under the same id, queries too
    spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(3).write.parquet(f"{tmp_path}/embeddings.parquet")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM read_parquet('{tmp_path}/embeddings.parquet/*.parquet')")
    wanted = con.execute(ORACLE["op4_exact_topk"]).fetchall()
    vectors = spark.read.parquet(f"{tmp_path}/embeddings.parquet")
    for sizes in ({}, {"block": 16, "query_block": 2}, {"block": 60}):
        _same(exact_topk.exact_topk(vectors, F.col("vec_id") % 50 == 0, **sizes).collect(), wanted)


def test_differing_calls_and_results_of_one_id_are_kept(spark, tmp_path):
    turns = [(1, 0, "user", "one"), (1, 0, "user", "two"), (1, 0, "user", "two"), (1, 1, "assistant", "yes"), (1, 1, "assistant", "no"),
             (1, 1, "assistant", None), (2, 0, "system", "set"), (2, 1, "user", "three"), (3, 1, "assistant", "b"), (3, 1, "assistant", "a")]
    spark.createDataFrame(turns, "conv_id long, turn long, role string, text string").write.parquet(f"{tmp_path}/conversations.parquet")
    found = [(r.conv_id, r.call_id, r.level, r.status, json.loads(r.json)) for r in QUERIES["op8_tool_calls"](spark, str(tmp_path)).collect()]
    text = lambda j: (j["arguments"] or {}).get("query") or (j["arguments"] or {}).get("text")
    _same([(c, i, level, s, text(j), j["content"]) for c, i, level, s, j in found], [
        (1, "1-0", 0, "ok", "one", "no"), (1, "1-0", None, "duplicate", "two", None), (1, "1-0", None, "duplicate", None, "yes"),
        (1, "1-0", None, "duplicate", None, None), (2, "2-0", 0, "unanswered", "set", None), (2, "2-1", 1, "unanswered", "three", None),
        (3, "3-0", None, "orphan", None, "a"), (3, "3-0", None, "duplicate", None, "b")])


def test_training_sample_is_bounded_in_chains(spark, monkeypatch):
    rng = random.Random(3)
    long = "\n".join(_words(rng, 3) for _ in range(48 * 40 + 5))
    rows = [(1, long), (1, long), (2, "### BAD\n### BAD"), (3, long[:4000]), (4, "### BAD")]
    assert all(zlib.crc32(str(i).encode()) % 5 for i, _ in rows)
    table = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(1, 1), (2, 0), (3, 1), (4, 0)], "doc_id long, quality int")
    given = []
    monkeypatch.setattr(crf_quality, "fit", lambda full, labels: given.append((full, labels)))
    for most in (10_000, 9):
        crf_quality.train(table, labels, sample_chains=most)
    (whole, marks), (few, _) = given
    wanted = [crf_quality.with_neighbours(crf_quality.line_features(t)[0].astype(np.float32).astype(float)) for _, t in dict(rows).items()]
    cut = [x[at:at + 48] for x in wanted for at in range(0, len(x), 48)]
    assert len(cut) == len(whole) and all(np.array_equal(a, b) for a, b in zip(cut, whole)) and marks.sum() == len(cut) - 2
    assert len(few) == 9 and max(map(len, few)) <= 48
    places = [k for k, x in enumerate(cut[:41]) for y in few if x.shape == y.shape and np.array_equal(x, y)]
    assert len(places) > 4 and max(places) > 12  # not the first ones of the long document


def test_calls_meet_results_in_hash_joins(spark):
    calls = spark.createDataFrame(CALLS, "conv_id long, turn long, call_id string, after string, name string, arguments string")
    results = spark.createDataFrame(RESULTS, "conv_id long, call_id string, content string")
    plan = chat_tools.link_tool_calls(calls, results, chat_tools.CHAT_SCHEMAS)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ShuffledHashJoin") == 2 and "SortMergeJoin" not in plan


def _plain_quality(text, field):
    """The score by sums over the two labels, line by line in plain Python, in logarithms."""
    own, weight = crf_quality.line_features(text)
    at = lambda k: own[k].tolist() if 0 <= k < len(own) else [0.0] * own.shape[1]
    last = len(own) - 1
    rows = [at(k) + at(k - 1) + at(k + 1) + [float(k == 0), float(k == last)] for k in range(len(own))]
    emit = [(0.0, sum(x * w for x, w in zip(row, field.weights.tolist()))) for row in rows]
    add = lambda x, y: max(x, y) + math.log1p(math.exp(-abs(x - y)))
    forth, back = [emit[0]], [(0.0, 0.0)]
    for e in emit[1:]:
        forth.append(tuple(e[y] + add(forth[-1][0] + field.steps[0, y], forth[-1][1] + field.steps[1, y]) for y in (0, 1)))
    for e in reversed(emit[1:]):
        back.append(tuple(add(field.steps[y, 0] + e[0] + back[-1][0], field.steps[y, 1] + e[1] + back[-1][1]) for y in (0, 1)))
    total = add(*forth[-1])
    good = [math.exp(f[1] + b[1] - total) for f, b in zip(forth, reversed(back))]
    return sum(g * w for g, w in zip(good, weight.tolist())) / sum(weight.tolist())


def test_every_score_equals_a_plain_chain(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    field = crf_quality.train(docs, spark.read.parquet("/root/testdata/sf0.001/labels.parquet"))
    assert field.constant is None
    texts = {r.doc_id: r.text or "" for r in docs.select("doc_id", "text").collect()}
    rows = crf_quality.score_documents(docs, field).collect()
    assert len(rows) == len(texts)
    for r in rows:
        assert math.isclose(r.score, _plain_quality(texts[r.doc_id], field), abs_tol=1e-9)
        assert r.predicted == int(r.score >= 0.3) and r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0)
