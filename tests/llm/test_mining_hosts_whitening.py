"""Hard negatives, host rules and whitening against plain computations on small tables of awkward rows."""

import itertools
import math
import random
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from layerforge.llm import hard_negatives, host_rules, whitening
from layerforge.llm.queries import ORACLE
from layerforge.session import ship_package

NAN, INF = float("nan"), float("inf")


def _vectors():
    """(vec_id, embedding, label): nulls, odd entries, ties, repeats, short and empty vectors, one hot direction."""
    rng = np.random.default_rng(3)
    rows = [(int(i), (x / np.linalg.norm(x)).astype(np.float32).tolist(), int(i) % 3) for i, x in enumerate(rng.normal(size=(300, 8)))]
    hot = rows[7][1]
    rows += [(300 + i, [float(c) for c in np.float32(hot) + np.float32(1e-3) * rng.normal(size=8).astype(np.float32)], i % 2) for i in range(150)]
    rows += [(500 + i, hot, 1) for i in range(20)]
    rows += [(600, None, 1), (601, hot, None), (602, [1.0, None], 1), (603, [NAN] + hot[1:], 0), (604, [INF] + hot[1:], 0), (None, hot, 0),
             (700, [0.5, 0.25], 1), (701, [], 0), (200, rows[200][1], 200 % 3), (200, rows[3][1], 0), (9, rows[9][1], 0), (800, [0.0] * 8, 2)]
    return rows


VECTORS = _vectors()
SCHEMA = "vec_id long, embedding array<float>, label int"


@pytest.fixture(scope="module")
def vectors(spark):
    ship_package(spark)
    df = spark.createDataFrame(VECTORS, SCHEMA)
    return df.select("*", *[F.lit(3).alias(c) for c in ("row", "key", "cell", "win", "score", "x", "weights", "n", "g")]).repartition(5)


def _able(v):
    return v is not None and all(c is not None and math.isfinite(c) for c in v)


def _mined(rows, every=100):
    w = [(i, (lab + 1) % 10 if i % 7 == 0 else lab, [math.floor(256 * float(np.float32(c))) for c in v])
         for i, v, lab in rows if i is not None and lab is not None and _able(v)]
    dot = lambda a, b: sum(x * y for x, y in zip(a, b))
    out = Counter()
    for i, lab, q in {(i, lab, tuple(v)) for i, lab, v in w if i % every == 0}:
        scored = [(-dot(q, v), j, lj) for j, lj, v in w if j != i]
        for s, p, _ in sorted(x for x in scored if x[2] == lab)[:5]:
            hits = sorted(x for x in scored if x[2] != lab and 30 * -s <= 100 * -x[0] <= 90 * -s)[:10]
            out.update((i, p, r + 1, n, -s, -t) for r, (t, n, _) in enumerate(hits))
    return out


def _label():
    return F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))


@pytest.mark.parametrize("cell_rows,group", [(256, 8192), (4, 8192), (8, 16)])
def test_hard_negatives(vectors, monkeypatch, cell_rows, group):
    monkeypatch.setattr(hard_negatives, "GROUP_ROWS", group)
    monkeypatch.setattr(hard_negatives, "GROUP_ANCHORS", max(1, group // 16))
    monkeypatch.setattr(hard_negatives, "FIRST_CELLS", 1)
    found = hard_negatives.mine_hard_negatives(vectors, F.col("vec_id") % 100 == 0, _label(), cell_rows=cell_rows)
    assert Counter(map(tuple, found.collect())) == _mined(VECTORS)
    assert len(_mined(VECTORS)) > 100


def test_hard_negatives_equal_their_sql_on_repeats(spark, tmp_path):
    rows = [r for r in VECTORS if r[1] is None or len(r[1]) == 8 and None not in r[1]]
    df = spark.createDataFrame(rows, SCHEMA)
    df.coalesce(1).write.parquet(f"{tmp_path}/v")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM read_parquet('{tmp_path}/v/*.parquet')")
    wanted = con.execute(ORACLE["op11_hard_negatives"]).fetchall()
    found = hard_negatives.mine_hard_negatives(df, F.col("vec_id") % 100 == 0, _label(), cell_rows=8)
    assert found.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    assert Counter(map(tuple, found.collect())) == Counter(wanted)


def test_hard_negatives_of_nothing_and_of_large_numbers(spark, vectors):
    mine = lambda df: hard_negatives.mine_hard_negatives(df, F.col("vec_id") % 100 == 0, _label(), cell_rows=2).collect()
    assert mine(vectors.limit(0)) == []
    assert mine(vectors.where("vec_id % 100 = 1")) == []
    rng = random.Random(2)
    rows = [(i, [rng.uniform(-1, 1) * 2.0 ** 22 for _ in range(4)], i % 2) for i in range(100, 220)]
    assert Counter(map(tuple, mine(spark.createDataFrame(rows, SCHEMA)))) == _mined(rows)


def test_cells_come_in_the_order_of_their_bounds():
    rng = np.random.default_rng(1)
    a, b = rng.normal(size=9), np.round(rng.normal(size=7))
    walk = list(hard_negatives.multi_sequence(a, b))
    assert sorted((i, j) for _, i, j in walk) == sorted(itertools.product(range(9), range(7)))
    assert all(np.isclose(s, a[i] + b[j]) for s, i, j in walk)
    assert [s for s, _, _ in walk] == sorted((s for s, _, _ in walk), reverse=True)


def test_bounds_spare_cells_of_clustered_vectors(spark, monkeypatch):
    """Well separated clusters: an anchor's rounds end long before all cells are read."""
    rng = np.random.default_rng(5)
    centres = rng.normal(size=(16, 16)) * 3
    rows = [(i, (centres[i % 16] + 0.01 * rng.normal(size=16)).tolist(), (i // 16) % 4) for i in range(3200)]
    asked = []
    plan = hard_negatives.stage
    monkeypatch.setattr(hard_negatives, "stage", lambda df, name: asked.append((name, plan(df, name))) or asked[-1][1])
    found = hard_negatives.mine_hard_negatives(spark.createDataFrame(rows, SCHEMA), F.col("vec_id") % 100 == 0, shares=(99, 100), cell_rows=32)
    assert found.count() > 0
    index = next(df for name, df in asked if name == "multi-index")
    n_cells = index.select("cell").distinct().count()
    visits = sum(df.agg(F.sum(F.size("cells"))).head()[0] or 0 for name, df in asked if name == "planned-cells")
    assert visits < 2 * 32 * n_cells / 4


TEXTS = [None, "", " \n\t ", "a b c a b c", "one two", "x " * 60, "# $ word & more | <a> " * 20, "line\nline\n \nother\nline", "é日本 \x1c ü",
         "\n".join(f"w{i} v{i} u{i}" for i in range(40)), "na na na na", "abcdefghijklmnop " * 70, "p q r s p q\x0br s"]


def _measure(text):
    import re
    t = text or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", t)
    lines = [x for x in t.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    at = defaultdict(list)
    for i in range(len(w) - 2):
        at[tuple(w[i:i + 3])].append(i)
    covered = {i + s for own in at.values() if len(own) > 1 for i in own for s in range(3)}
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in t), len(lines) - len(set(lines)), len(covered), len(lines)


def _judge(rows, limit=0.5):
    m = [(d, h, *_measure(t)) for d, h, t in rows]
    rules = [lambda r: r[2] < 50, lambda r: 100 * r[6] > 50 * r[2], lambda r: 100 * r[4] > 10 * r[2],
             lambda r: r[3] < 3 * r[2] or r[3] > 10 * r[2], lambda r: 100 * r[5] > 30 * r[7]]
    hosts = defaultdict(list)
    for r in m:
        if r[1] is not None:
            hosts[r[1]].append(r)
    bad, total = set(), sum(map(len, hosts.values()))
    for rule in rules:
        f = {h: sum(map(rule, own)) for h, own in hosts.items()}
        mean = sum(f.values()) / total if total else 0
        strength = None
        if 0 < mean < 1:
            spread = sum(len(hosts[h]) * (f[h] / len(hosts[h]) - mean) ** 2 for h in hosts)
            room = total - sum(len(o) ** 2 for o in hosts.values()) / total - (len(hosts) - 1)
            excess = spread / (mean * (1 - mean)) - (len(hosts) - 1)
            strength = max(room / excess - 1, 0) if room > 0 and excess > 0 else None
        for h, own in hosts.items():
            if (mean if strength is None else (f[h] + strength * mean) / (len(own) + strength)) > limit:
                bad.add(h)
    out = Counter()
    for r in m:
        base = rules[0](r) or rules[1](r)
        out[(r[0], *r[2:7], base, r[1] in bad, not base and r[1] not in bad)] += 1
    return out, bad


def _host_rows():
    rng = random.Random(4)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(rng.randint(4, 7)))
    good = lambda: " ".join(word() for _ in range(rng.randint(60, 90)))
    rows = [(i, rng.choice(["h0", "h1", None, ""]), t) for i, t in enumerate(TEXTS)] + [(0, "h1", None), (None, "h2", "x y")]
    rows += [(100 + i, "big" if i % 3 == 0 else f"h{i % 9}", good()) for i in range(300)]
    rows += [(500 + i, "junk", "# % " * 60 if i % 10 else good()) for i in range(60)]  # most break a rule, a few are clean
    rows += [(600 + i, "small", "# % " * 60) for i in range(1)] + [(610 + i, f"t{i}", good()) for i in range(40)]
    return rows


@pytest.fixture(scope="module")
def host_docs(spark):
    ship_package(spark)
    df = spark.createDataFrame(_host_rows(), "doc_id long, source string, text string")
    return df.select("*", *[F.lit(1).alias(c) for c in ("n_words", "N_LINES", "host", "rejected", "host_rejected", "few_words")]).repartition(4)


def test_host_rules(host_docs, monkeypatch):
    monkeypatch.setattr(host_rules, "SLICE", 3000)
    wanted, bad = _judge(_host_rows())
    assert "junk" in bad and "big" not in bad and len(bad) < 10
    assert Counter(map(tuple, host_rules.judge_documents(host_docs).collect())) == wanted
    kept = host_rules.keep_documents(host_docs)
    assert kept.columns == host_docs.columns
    assert Counter(r.doc_id for r in kept.collect()) == Counter({k[0]: n for k, n in wanted.items() if k[-1]})
    assert host_rules.judge_documents(host_docs.limit(0)).collect() == []


def test_host_rules_equal_their_sql(spark, host_docs, tmp_path):
    host_docs.select("doc_id", "source", "text").write.parquet(f"{tmp_path}/d")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{tmp_path}/d/*.parquet')")
    for limit in (0.5, 0.03):
        cur = con.execute(host_rules.oracle_sql(limit=limit))
        rows = cur.fetchall()
        found = host_rules.judge_documents(host_docs, limit=limit)
        assert found.columns == [d[0] for d in cur.description]
        assert Counter(map(tuple, found.collect())) == Counter(rows)
        assert any(r[-2] for r in rows) and not all(r[-2] for r in rows)


def test_hosts_that_differ_by_chance_have_one_rate(spark):
    hosts = spark.createDataFrame([("a", 10, 5, 0), ("b", 20, 10, 0), ("c", 2, 1, 0)], "host string, n_docs long, r long, z long")
    assert host_rules.beta_priors(hosts, ["r", "z"]) == {"r": (0.5, None), "z": (0.0, None)}
    rows = [(f"h{i}", 100, 10 + i % 7) for i in range(70)] + [("new", 1, 1), ("bad", 100, 90)]
    hosts = spark.createDataFrame([(h, f"{f} 1" if k < f else "0 0") for h, n, f in rows for k in range(n)], "h string, mark string")
    found = {r.host: r for r in host_rules.host_verdicts(hosts, "h", {"r": F.col("mark").endswith("1")}, 0.4).collect()}
    assert found["new"].r_rate < 0.4 < found["bad"].r_rate < 0.9  # one document says too little, a hundred are enough
    assert [h for h, r in found.items() if r.rejected] == ["bad"]
    mean, strength = host_rules.beta_priors(spark.createDataFrame([("a", 10, 10), ("b", 10, 0)], "host string, n_docs long, r long"), ["r"])["r"]
    assert mean == 0.5 and strength == 0.0  # nothing in between: hosts speak for themselves


def _integers(rows):
    width = max(len(v) for _, v, _ in rows if _able(v))
    return [(i, [math.floor(64 * float(np.float32(c))) + 1_000_000 for c in v] + [1_000_000] * (width - len(v))) for i, v, _ in rows if _able(v)]


def test_whitening(vectors):
    rows = _integers(VECTORS)
    fit = sorted({tuple(x) for _, x in rows})
    n, width = len(fit), len(fit[0])
    sums = [sum(c) for c in zip(*fit)]
    centred = np.array([[(n * c - s) / n for c, s in zip(x, sums)] for x in fit])
    v = centred.T @ centred / n
    values, axes = np.linalg.eigh(v)
    values, axes = values[::-1], axes[:, ::-1]
    found = whitening.whiten(vectors).collect()
    got = defaultdict(list)
    for r in found:
        got[(r.vec_id, r.deviation)].append(r)
    wanted = defaultdict(list)
    for i, x in rows:
        y = np.array([(n * c - s) / n for c, s in zip(x, sums)])
        wanted[(i, sum((n * c - s) ** 2 for c, s in zip(x, sums)))].append(y @ axes / np.sqrt(values))
    assert {k: len(x) for k, x in got.items()} == {k: len(x) * width for k, x in wanted.items()}
    signs = None
    for key, own in got.items():
        want = wanted[key]
        for c in range(width):
            mine = sorted(r.whitened for r in own if r.component == c + 1)
            if signs is None:
                signs = {}
            if c not in signs and abs(mine[0]) > 1e-6 and len(set(mine)) == 1:
                signs[c] = math.copysign(1, mine[0] * want[0][c])
        assert {r.n for r in own} == {n}
        assert all(r.deviation_text == str(r.deviation) for r in own)
    for key, own in got.items():
        for c in range(width):
            mine = sorted(r.whitened for r in own if r.component == c + 1)
            assert np.allclose(mine, sorted(signs[c] * w[c] for w in wanted[key]), atol=1e-9)
    for r in found:
        assert abs(r.explained - values[r.component - 1] / np.trace(v)) < 1e-12 and r.identity_error < 1e-9


def test_whitening_of_odd_tables(spark, vectors):
    of = lambda rows: whitening.whiten(spark.createDataFrame([(i, v, 0) for i, v in rows], SCHEMA)).collect()
    assert whitening.whiten(vectors.limit(0)).collect() == []
    assert of([(1, [1.0, 2.0]), (2, [1.0, 2.0])]) == [] and of([(1, [])]) == [] and of([(1, None)]) == []
    flat = of([(1, [1.0, 0.0, 2.0]), (2, [1.0, 1.0, 3.0]), (None, [1.0, 1.0, 3.0])])  # one direction alone has variance
    assert {r.component for r in flat} == {1} and sorted(round(abs(r.whitened), 9) for r in flat) == [1.0] * 3
    assert {r.n for r in flat} == {2} and {r.vec_id for r in flat} == {1, 2, None}
    large = of([(1, [1e15, 0.0]), (2, [-1e15, 1.0]), (3, [3e15, 9.0])])
    x = {1: (64 * 10 ** 15 + 10 ** 6, 10 ** 6), 2: (-64 * 10 ** 15 + 10 ** 6, 64 + 10 ** 6), 3: (192 * 10 ** 15 + 10 ** 6, 576 + 10 ** 6)}
    x = {i: (math.floor(64 * float(np.float32(c))) + 10 ** 6, x[i][1]) for i, c in ((1, 1e15), (2, -1e15), (3, 3e15))}
    s = [sum(c) for c in zip(*x.values())]
    far = {i: sum((3 * c - t) ** 2 for c, t in zip(own, s)) for i, own in x.items()}
    assert {(r.vec_id, r.deviation, r.deviation_text) for r in large} == {(i, d if d < 1 << 63 else None, str(d)) for i, d in far.items()}


@pytest.mark.parametrize("size,kind", list(itertools.product((1, 2, 3, 17, 60), ("random", "equal", "blocks", "graded"))))
def test_eigenvectors_to_double_precision(size, kind):
    rng = np.random.default_rng(size)
    if kind == "random":
        b = rng.normal(size=(size, 2 * size))
    elif kind == "graded":
        b = rng.normal(size=(size, size)) * (3.0 ** -np.arange(size))[:, None]
    else:
        b = np.eye(size) if kind == "equal" else np.diag(np.repeat([3.0, 1.0, 1.0], size)[:size])
    v, k = b @ b.T, min(size, 16)
    values, vectors = whitening.eigen(v, k)
    assert np.allclose(values, np.linalg.eigvalsh(v)[::-1][:k], atol=1e-13 * values[0], rtol=0)
    assert np.abs(v @ vectors - vectors * values).max() < 1e-13 * values[0]
    assert np.abs(vectors.T @ vectors - np.eye(k)).max() < 1e-12


def test_partial_sums_merge():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(50, 3)) + 100
    parts = [(len(p), p.mean(axis=0), (p - p.mean(axis=0)).T @ (p - p.mean(axis=0))) for p in np.split(x, [1, 20, 45])]
    held = None
    for p in parts:
        held = whitening.merged(held, p)
    assert held[0] == 50 and np.allclose(held[2] / 50, np.cov(x.T, bias=True))
