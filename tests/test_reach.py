"""Reach labels: counts and asked pairs against a plain search, and no pairs where no ways part."""

import random

import pytest

from layerforge.operators import lineage as LN
from layerforge.operators import reach
from layerforge.operators.reach import all_pairs, reach_counts, reach_labels, reaches


def _plain(edges):
    on = {}
    for a, b in edges:
        on.setdefault(a, set()).add(b)
    reached = {}
    for start in {x for e in edges for x in e}:
        seen, todo = set(), [start]
        while todo:
            for b in on.get(todo.pop(), ()):
                if b not in seen:
                    seen.add(b)
                    todo.append(b)
        reached[start] = seen
    return reached


def _graphs():
    """Graphs of several kinds side by side, as one: each has numbers of its own."""
    rng = random.Random(11)
    kinds = [
        [*[(i, i // 2) for i in range(1, 40)], (0, 0)],  # a tree with a loop at its root
        [(1, 2), (2, 3), (3, 1), (9, 1), (8, 9), (7, 8), (6, 3), (20, 21), (21, 20)],  # cycles with tails
        [(i, i + 1) for i in range(70)],
        [(1, 2), (2, 3), (3, 4), (4, 1), (4, 5), (5, 6), (10, 2), (11, 10), (12, 3), (6, 7), (6, 8), (7, 9), (8, 9)],  # ways part on a cycle
    ]
    kinds += [[(rng.randrange(n), rng.randrange(n)) for _ in range(m)] for n, m in ((12, 9), (15, 16), (15, 26), (30, 33), (30, 40))]
    return [(1000 * k + a, 1000 * k + b) for k, edges in enumerate(kinds) for a, b in edges]


@pytest.mark.parametrize("turned", [False, True])
def test_labels_equal_a_plain_search(spark, turned):
    edges = _graphs()
    df = spark.createDataFrame([*edges, *edges[:5]], "src long, dst long")  # a repeated edge counts once
    want = _plain(edges)
    found = reach_labels(df, turned)
    got = {r.asset: (r.n_downstream, r.n_upstream) for r in reach_counts(found).collect()}
    assert got == {a: (len(r), sum(a in x for x in want.values())) for a, r in want.items()}
    asked = [(a, b) for a in [*want, 999_999] for b in [*want, 999_998] if a // 1000 == b // 1000]
    answers = reaches(found, spark.createDataFrame([*asked, *asked[:9]], "asset long, other long")).collect()
    assert len(answers) == len(asked)
    assert {(r.asset, r.other) for r in answers if r.reached} == {(a, b) for a, r in want.items() for b in r}


def test_no_pairs_without_parting_ways(spark):
    tree = spark.createDataFrame([(i, i // 2) for i in range(1, 200)], "src long, dst long")
    up = spark.createDataFrame([(i // 2, i) for i in range(1, 200)], "src long, dst long")
    for edges in (tree, up):  # the second is read against its direction
        found = reach_labels(edges)
        assert found.pairs.count() == 0 and found.labels.count() == 200
    assert found.turned


def test_empty_graph_null_ends_and_names(spark):
    empty = spark.createDataFrame([], "src string, dst string")
    assert reach_counts(reach_labels(empty)).count() == 0
    edges = spark.createDataFrame([("a", "b"), ("b", None), (None, "a"), ("b", "c")], "src string, dst string")
    assert {tuple(r) for r in reach_counts(reach_labels(edges)).collect()} == {("a", 2, 0), ("b", 1, 1), ("c", 0, 2)}


def test_impact_and_report_of_the_warehouse_need_no_pair_table(spark):
    edges = LN.edges_from_transformations(LN.warehouse_transformations(spark)).select("src", "dst")
    counts, pairs = reach_counts(reach_labels(edges)), LN.closure(edges)
    rows = lambda df: sorted(tuple(r) for r in df.collect())
    assert rows(LN.impact(edges, counts=counts)) == rows(LN.impact(edges, pairs))
    assert rows(LN.report(edges, counts=counts)) == rows(LN.report(edges, pairs))


@pytest.mark.parametrize("turned, hops", [(False, 1), (True, 6)])
def test_all_pairs_equal_a_plain_search(spark, monkeypatch, turned, hops):
    monkeypatch.setattr(reach, "BLOCK_HOPS", hops)  # with short lists a way is many of them
    edges = [(a, b) for a, b in _graphs() if not 2010 < max(a, b) < 3000]  # of the long chain the start alone
    found = reach_labels(spark.createDataFrame([*edges, *edges[:5]], "src long, dst long"), turned)
    want = sorted((a, b) for a, r in _plain(edges).items() for b in r)
    assert sorted(tuple(r) for r in all_pairs(found).collect()) == want  # each pair once
    assert sorted((r.reached, r.asset) for r in all_pairs(found, reverse=True).collect()) == want


def test_closure_of_a_tree_searches_only_what_its_top_reaches(spark, monkeypatch):
    """Both directions: the frontier search, which shuffles pairs, is left with the one pair of the root."""
    searched = []
    search = LN.pairs_from

    def counted(*args, **kwargs):
        searched.append(search(*args, **kwargs))
        return searched[-1]

    monkeypatch.setattr(LN, "pairs_from", counted)
    monkeypatch.setattr(reach, "pairs_from", counted)
    edges = [(i, i // 2) for i in range(300)]
    want = sorted((a, b) for a, r in _plain(edges).items() for b in r)
    df = spark.createDataFrame(edges, "src long, dst long")
    assert sorted(tuple(r) for r in LN.closure(df).collect()) == want
    assert sorted((r.reached, r.asset) for r in LN.closure(df, reverse=True).collect()) == want
    assert [[tuple(r) for r in pairs.collect()] for pairs in searched] == [[(0, 0)], [(0, 0)]]


def test_closure_keeps_pairs_with_null_ends(spark):
    edges = spark.createDataFrame([("a", "b"), ("b", None), (None, "a"), ("b", "c"), ("c", "b")], "src string, dst string")
    want = {(a, b) for a in ("a", "b", "c", None) for b in ("b", "c", None)} | {(None, "a")}
    got = [tuple(r) for r in LN.closure(edges).collect()]
    assert set(got) == want and len(got) == len(want)
