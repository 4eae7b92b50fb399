import random
from decimal import Decimal

from pyspark.sql import functions as F

from chainscope.operators import detect, lineage, peeling, scc


def _brute_members(edges):
    verts = sorted({v for e in edges for v in e})
    out = {}
    adj = {v: {d for s, d in edges if s == v} for v in verts}

    def reach(v):
        seen, todo = {v}, [v]
        while todo:
            for w in adj[todo.pop()] - seen:
                seen.add(w)
                todo.append(w)
        return seen

    reached = {v: reach(v) for v in verts}
    for v in verts:
        comp = [u for u in reached[v] if v in reached[u]]
        if len(comp) >= 2:
            out[v] = min(comp)
    return out


def test_components_match_mutual_reachability(spark):
    """Many small random graphs at once, a ring and a path."""
    rng = random.Random(4)
    rows, want = [], {}
    for lvl in range(60):
        n = rng.randint(2, 14)
        edges = [(rng.randrange(n), rng.randrange(n)) for _ in range(rng.randint(1, 2 * n))]
        edges = [(a, b) for a, b in edges if a != b]
        rows += [(lvl, a, b) for a, b in edges]
        want.update({(lvl, v): r for v, r in _brute_members(edges).items()})
    rows += [(100, i, (i + 1) % 40) for i in range(40)] + [(101, i, i + 1) for i in range(30)]
    want.update({(100, i): 0 for i in range(40)})
    got = scc.scc_members(spark, spark.createDataFrame(rows, "lvl LONG, src LONG, dst LONG")).collect()
    assert {(r.lvl, r.v): r.root for r in got} == want and len(got) == len(want)


def test_id_mix_is_one_to_one(spark):
    ids = [0, 1, -1, 2**63 - 1, -2**63, 12345, 8589934592]
    df = spark.createDataFrame([(i, i) for i in ids], "a LONG, b LONG")
    back = scc._mix(scc._mix(df, ["a"]), ["a"], back=True)
    assert all(r.a == r.b for r in back.collect())


def test_tree_matches_the_peel_loop(spark):
    """Sets, rounds, members, edges and sums against the literal loop, with
    weights beyond one step of the division."""
    rng = random.Random(3)
    verts = [f"x{i:02d}" for i in range(22)]
    weight = {}
    for _ in range(110):
        a, b = rng.sample(verts, 2)
        weight[a, b] = rng.choice([1, 2, 3, 5, 17, 18, 40])
    df = spark.createDataFrame([(a, b, w, Decimal(10 * w)) for (a, b), w in weight.items()],
                               "src STRING, dst STRING, weight BIGINT, value DECIMAL(38,0)")
    rounds = {}
    for r in range(1, max(weight.values()) + 1):
        by_root = {}
        for v, root in _brute_members([e for e, w in weight.items() if w >= r]).items():
            by_root.setdefault(root, set()).add(v)
        for members in by_root.values():
            rounds.setdefault(frozenset(members), []).append(r)
    tree = peeling.merge_tree(spark, df)
    name = {m: (min(m), len(m)) for m in rounds}
    occ = {(r.set_key, r.n_members): (r.occurrences, r.first_round, r.last_round) for r in detect.scc_occurrences(tree).collect()}
    assert occ == {name[m]: (len(rs), min(rs), max(rs)) for m, rs in rounds.items()} and len(rounds) > 4
    members = [tuple(r) for r in detect.set_members(tree).collect()]
    assert sorted(members) == sorted((*name[m], v) for m in rounds for v in m)
    inside = {m: [w for (a, b), w in weight.items() if a in m and b in m] for m in rounds}
    volume = {tuple(r)[:2]: tuple(r)[2:] for r in detect.wash_set_volume(detect.scc_occurrences(tree), tree).collect()}
    assert volume == {name[m]: (len(ws), sum(ws), Decimal(10 * sum(ws))) for m, ws in inside.items()}
    worst = {(r.set_key, r.n_members): int(r.max_member_net)
             for r in detect.member_volume_match(detect.scc_occurrences(tree), tree).collect()}
    assert worst == {name[m]: max(abs(sum(10 * w * ((b == v) - (a == v)) for (a, b), w in weight.items() if a in m and b in m))
                                  for v in m) for m in rounds}
    counts = {r.address: (r.n_rounds, r.n_sets) for r in detect.vertex_scc_counts(tree).collect()}
    assert counts == {v: (sum(len(rs) for m, rs in rounds.items() if v in m), sum(v in m for m in rounds))
                      for m in rounds for v in m}


def test_no_table_goes_through_the_driver(spark, monkeypatch):
    """Not one join of the tree, its members and balances, and the components
    is by broadcast, small as the tables are here."""
    plans = []

    def watch(df):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return df

    read = lineage.Scratch._read
    monkeypatch.setattr(lineage.Scratch, "_read", lambda self, df, path: read(self, watch(df), path))
    triples = [("a", "b", 2), ("b", "a", 2), ("b", "c", 1), ("c", "a", 1)]
    edges = spark.createDataFrame([(s, d, w, Decimal(w)) for s, d, w in triples], "src STRING, dst STRING, weight BIGINT, value DECIMAL(38,0)")
    tree = peeling.merge_tree(spark, edges)
    net = edges.select(F.col("src").alias("address"), F.col("value").alias("net_value")).groupBy("address").agg(
        F.sum("net_value").alias("net_value"))
    for df in (detect.set_members(tree), detect.volume_match(detect.scc_occurrences(tree), tree, net),
               detect.member_volume_match(detect.scc_occurrences(tree), tree), scc.scc_components(spark, edges)):
        assert watch(df).count() > 0
    assert len(plans) > 20 and not [p for p in plans if "Broadcast" in p]
