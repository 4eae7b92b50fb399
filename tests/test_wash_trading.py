from decimal import Decimal

import pytest

from chainscope.operators import detect, graph, peeling, scc, transfers
from conftest import SAMPLE_TX, WASHED_TX, typed

LIMIT = 1.976249070762444e19


def _net_and_stats(spark, rows):
    kept = transfers.without_self_trades(typed(spark, rows))
    return transfers.net_positions(kept), transfers.transfer_stats(kept)


def test_self_trades(spark):
    st = transfers.self_trades(typed(spark, SAMPLE_TX)).collect()
    assert [(r.address, r.value, r.ts) for r in st] == [("c8ebcc", Decimal(0), 1438919451)]
    summary = transfers.self_trade_summary(typed(spark, SAMPLE_TX)).collect()
    assert [(r.address, r.n_self_trades) for r in summary] == [("c8ebcc", 1)]


def test_null_receiver_is_not_a_self_trade(spark):
    rows = [("x", "a", None, "1", "1"), ("y", "a", "a", "1", "1"), ("z", None, None, "1", "1")]
    df = typed(spark, rows)
    assert sorted(r.hash for r in transfers.self_trades(df).collect()) == ["y", "z"]
    assert [r.hash for r in transfers.without_self_trades(df).collect()] == ["x"]


def test_transfer_stats_after_self_trades(spark):
    _, stats = _net_and_stats(spark, SAMPLE_TX)
    r = stats.collect()[0]
    assert r.n_transfers == 8
    assert r.avg_value == pytest.approx(1.317499380508296e+20, rel=1e-15)


@pytest.mark.parametrize("rows,n_accounts,expected", [
    (SAMPLE_TX, 15, {"a1e438": -62674, "c9d403": 31337, "5df9b8": 31337, "fd2605": -10000000000000000,
                     "073f70": 10000000000000000, "bbed46": -4406636741121, "bf8d8b": 4406636741121}),
    (WASHED_TX, 13, {"a1e438": -31337, "c9d403": 31337, "fd2605": -9999999999968663,
                     "bbed46": -4406636741121, "bf8d8b": 4406636741121}),
])
def test_net_neutral_candidates(spark, rows, n_accounts, expected):
    net, stats = _net_and_stats(spark, rows)
    assert net.count() == n_accounts
    got = {r.address: int(r.net_value) for r in transfers.net_neutral(net, stats).collect()}
    assert got == expected
    cnt = transfers.net_neutral_count(net, stats).collect()[0]
    assert (cnt.n_candidates, cnt.n_transfers) == (len(expected), 8)


def test_washed_net_positions(spark):
    net, _ = _net_and_stats(spark, WASHED_TX)
    got = {r.address: int(r.net_value) for r in net.collect()}
    assert got["3f2f38"] == -803979500000000000000
    assert got["4bd5f0"] == 803989499999999968663
    assert sum(got.values()) == 0


def _edges(spark, triples):
    return spark.createDataFrame([(s, d, w, Decimal(w)) for s, d, w in triples],
                                 "src STRING, dst STRING, weight BIGINT, value DECIMAL(38,0)")


def _occurrences(spark, triples):
    tree = peeling.merge_tree(spark, _edges(spark, triples))
    sets = {}
    for r in detect.set_members(tree).collect():
        sets.setdefault((r.set_key, r.n_members), set()).add(r.address)
    return sorted((tuple(sorted(sets[(r.set_key, r.n_members)])), r.occurrences)
                  for r in detect.scc_occurrences(tree).collect())


HAND_CASES = [
    ("p", [("a", "b", 3), ("b", "a", 3)], [({"a", "b"}, 3)]),
    ("q", [("a", "b", 4), ("b", "a", 2)], [({"a", "b"}, 2)]),
    ("r", [("a", "b", 1), ("b", "c", 1), ("c", "a", 1)], [({"a", "b", "c"}, 1)]),
    ("s", [("a", "b", 3), ("b", "a", 3), ("b", "c", 1), ("c", "b", 1)], [({"a", "b", "c"}, 1), ({"a", "b"}, 2)]),
    ("t", [("a", "b", 5), ("b", "c", 5)], []),
    ("u", [("a", "b", 1), ("b", "a", 1), ("c", "d", 1), ("d", "c", 1)], [({"a", "b"}, 1), ({"c", "d"}, 1)]),
]


def _combined(cases):
    triples, expected = [], []
    for tag, edges, exp in cases:
        triples += [(tag + s, tag + d, w) for s, d, w in edges]
        expected += [(tuple(sorted(tag + m for m in members)), n) for members, n in exp]
    return triples, sorted(expected)


def test_peeling_hand_cases(spark):
    ring = [(f"v{i:02d}", f"v{(i + 1) % 50:02d}", 1) for i in range(50)]
    deep = [("a", "b", 40), ("b", "a", 33), ("b", "c", 20), ("c", "a", 17)]
    triples, expected = _combined(HAND_CASES + [("w", ring, [({f"v{i:02d}" for i in range(50)}, 1)]),
                                                ("x", deep, [({"a", "b"}, 16), ({"a", "b", "c"}, 17)])])
    assert _occurrences(spark, triples) == expected


def test_washed_sample_loop_occurs_once_below_threshold(spark):
    kept = transfers.without_self_trades(typed(spark, WASHED_TX))
    occ = detect.scc_occurrences(peeling.merge_tree(spark, graph.graph_edges(kept)))
    assert [(r.set_key, r.n_members, r.occurrences) for r in occ.collect()] == [("3f2f38", 3, 1)]
    assert detect.scc_candidates(occ).count() == 0


def test_sample_has_no_loops(spark):
    kept = transfers.without_self_trades(typed(spark, SAMPLE_TX))
    tree = peeling.merge_tree(spark, graph.graph_edges(kept))
    assert tree.sets.count() == tree.accounts.count() == 0


def test_reciprocal_pairs(spark):
    e = _edges(spark, [("a", "b", 2), ("b", "a", 1), ("b", "c", 1), ("c", "d", 1), ("d", "c", 4)])
    got = sorted((r.a, r.b, r.weight_ab, r.weight_ba) for r in detect.reciprocal_pairs(e).collect())
    assert got == [("a", "b", 2, 1), ("c", "d", 1, 4)]


def test_graph_vertices_keep_min_token(spark):
    t = spark.createDataFrame([("h1", "a", "b", Decimal(1), 1, "y"), ("h2", "b", "a", Decimal(1), 1, "x")],
                              "hash STRING, from_address STRING, to_address STRING, value DECIMAL(38,0), "
                              "block_timestamp BIGINT, token_type STRING")
    got = sorted(tuple(r) for r in graph.graph_vertices(t).collect())
    assert got == [("a", "x"), ("b", "x")]
    peeled = graph.edge_peel(graph.graph_edges(t))
    assert peeled.count() == 0
    assert graph.vertices_with_edges(graph.graph_vertices(t), peeled).count() == 0


def test_balance_and_trader_of_two_sets(spark):
    # {a, b} is balanced both ways; c sends d far more than it gets back, and e far more to itself in a loop of zeros
    rows = []
    for i in range(3):
        rows += [(f"ab{i}", "a", "b", "100", "1"), (f"ba{i}", "b", "a", "100", "1"),
                 (f"cd{i}", "c", "d", "1000", "1"), (f"dc{i}", "d", "c", "10", "1"),
                 (f"pq{i}", "p", "q", "0", "1"), (f"qp{i}", "q", "p", "0", "1")]
    kept = transfers.without_self_trades(typed(spark, rows))
    edges = graph.graph_edges(kept)
    tree, net = peeling.merge_tree(spark, edges), transfers.net_positions(kept)
    cands = detect.scc_candidates(detect.scc_occurrences(tree))
    member = {r.set_key: (int(r.inner_volume), int(r.max_member_net), r.member_matched)
              for r in detect.member_volume_match(cands, tree).collect()}
    assert member == {"a": (600, 0, True), "c": (3030, 2970, False), "p": (0, 0, True)}
    volume = {r.set_key: (int(r.net_sum), r.net_mean, int(r.abs_sum), r.volume_matched)
              for r in detect.volume_match(cands, tree, net).collect()}
    assert volume == {"a": (0, 0.0, 0, True), "c": (0, 0.0, 5940, True), "p": (0, 0.0, 0, True)}
    matched = detect.matched_sets(tree, net)
    share = {r.address: (int(r.wash_volume), r.wash_share) for r in
             detect.wash_volume_by_account(tree, matched, edges).collect()}
    assert share["c"] == (3030, 1.0) and share["p"] == (0, None) and len(share) == 6
    assert [r.address for r in detect.top_wash_trader(tree, matched, edges).collect()] == ["c"]


def test_empty_graph(spark):
    rows = [("h1", "a", "a", "5", "1"), ("h2", "b", "b", "7", "2")]  # self-trades only
    edges = graph.graph_edges(transfers.without_self_trades(typed(spark, rows)))
    assert scc.scc_components(spark, edges).count() == 0
    tree = peeling.merge_tree(spark, edges)
    assert detect.scc_occurrences(tree).count() == detect.set_members(tree).count() == 0


def test_round_budget_raises_instead_of_partial_result(spark):
    ring = [(f"v{i}", f"v{(i + 1) % 6}", 1) for i in range(6)]
    with pytest.raises(scc.RoundLimitExceeded):
        peeling.merge_tree(spark, _edges(spark, ring), max_rounds=2)
