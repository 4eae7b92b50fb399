import itertools
import random
from decimal import Decimal

from chainscope.operators import cycles


def _brute(edges, k):
    adj = {(s, d): w for s, d, w in edges}
    verts = sorted({v for s, d, _ in edges for v in (s, d)})
    out = set()
    for combo in itertools.permutations(verts, k):
        if combo[0] != min(combo):
            continue
        ws = [adj.get((combo[i], combo[(i + 1) % k])) for i in range(k)]
        if all(w is not None for w in ws):
            out.add(combo + (min(ws),))
    return out


def test_loops_match_brute_force(spark):
    rng = random.Random(5)
    for trial in range(3):
        verts = [f"a{i}" for i in range(9)]
        edges = {(s, d): rng.randint(1, 4) for s in verts for d in verts if s != d and rng.random() < 0.35}
        # a hub: one account linked both ways to all others
        for v in verts[1:]:
            edges[("a0", v)] = 1
            edges[(v, "a0")] = 2
        triples = [(s, d, w) for (s, d), w in edges.items()]
        df = spark.createDataFrame([(s, d, w, Decimal(w)) for s, d, w in triples],
                                   "src STRING, dst STRING, weight BIGINT, value DECIMAL(38,0)")
        got3 = {tuple(r) for r in cycles.cycles_3(df).collect()}
        got4 = {tuple(r) for r in cycles.cycles_4(df).collect()}
        assert got3 == _brute(triples, 3)
        assert got4 == _brute(triples, 4)
        assert cycles.cycles_3(df).count() == len(got3)
        assert cycles.cycles_4(df).count() == len(got4)
