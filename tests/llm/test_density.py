import numpy as np
import pytest

from tesselon.llm import density as D

SCHEMA = "id long, x array<float>, cluster string, node int"


def cloud(seed, dims=32, sets=(2, 3, 5, 40, 300), singles=150, spread=0.13):
    rng = np.random.default_rng(seed)
    rows = []
    for n in sets:
        c = rng.standard_normal(dims)
        c /= np.linalg.norm(c)
        rows += [c + spread * rng.standard_normal(dims) / np.sqrt(dims) * 1.0 for _ in range(n)]
    rows += list(rng.standard_normal((singles, dims)))
    order = rng.permutation(len(rows))
    return np.array(rows)[order].astype(np.float32)


def brute_sets(ids, x, limit=0.95):
    v = x.astype(np.float64)
    v /= np.linalg.norm(v, axis=1, keepdims=True)
    near = [np.flatnonzero(r >= limit) for r in v @ v.T]
    return {(int(ids[i]), int(ids[r].min())) for i, r in enumerate(near) if len(r) > 1 and all(np.array_equal(near[j], r) for j in r)}


def frame(spark, ids, x, extra=()):
    rows = [(int(i), [float(a) for a in r], "noise", 0) for i, r in zip(ids, x)]
    return spark.createDataFrame(rows + list(extra), SCHEMA)


@pytest.mark.parametrize("seed", [0, 1])
def test_sets(spark, seed):
    x = cloud(seed)
    ids = np.random.default_rng(seed).permutation(len(x)) + 10
    extra = [(9_001, None, None, None), (9_002, [], None, None), (9_003, [0.0] * 32, None, None), (9_004, [float("nan")] * 32, None, None), (None, [1.0] * 32, None, None), (9_005, [1.0, 2.0], None, None)]
    again = [(int(ids[k]), [float(a) for a in x[k]], "twice", 1) for k in range(60)]
    graph = D.neighbour_graph(frame(spark, ids, x, extra + again), "id", "x")
    got = [(r.id, r.cluster) for r in D.similar_sets(graph, D.hierarchy(graph)).collect()]
    assert len(got) == len(set(got)) and set(got) == brute_sets(ids, x)


def test_chains_are_no_sets(spark):
    rng = np.random.default_rng(5)
    a, b = np.linalg.qr(rng.standard_normal((32, 2)))[0].T
    x = np.array([np.cos(t) * a + np.sin(t) * b for t in np.deg2rad(np.arange(0, 90, 12))] + [np.cos(t) * a - np.sin(t) * b for t in np.deg2rad([150, 158, 167])]).astype(np.float32)
    ids = np.arange(len(x))
    graph = D.neighbour_graph(frame(spark, ids, x), "id", "x")
    assert {(r.id, r.cluster) for r in D.similar_sets(graph, D.hierarchy(graph)).collect()} == brute_sets(ids, x)


def test_wide_set_is_decided_member_by_member(spark):
    rng = np.random.default_rng(6)
    base = np.zeros(32)
    base[0] = 1
    d = rng.standard_normal((3, 32))
    d[:, 0] = 0
    d /= np.linalg.norm(d, axis=1, keepdims=True)
    x = np.array([np.cos(0.17) * base + np.sin(0.17) * e for e in d] + [base]).astype(np.float32)
    ids = np.arange(len(x))
    graph = D.neighbour_graph(frame(spark, ids, x), "id", "x")
    assert {(r.id, r.cluster) for r in D.similar_sets(graph, D.hierarchy(graph)).collect()} == brute_sets(ids, x)


def test_clusters(spark):
    x = cloud(3, sets=(60, 30))
    rows, found = D.clusters(D.neighbour_graph(frame(spark, np.arange(len(x)), x), "id", "x"))
    found = found.collect()
    assert sorted(r["size"] for r in found) == [30, 60]
    members = {}
    for r in rows.collect():
        members.setdefault(r.cluster, []).append((-r.strength, r.id))
    for r in found:
        own = sorted(members[r.cluster])
        assert r.cluster == min(i for _, i in own) and r.exemplars == [i for _, i in own[:3]]


def test_tree_matches_brute_force_weight(spark):
    rng = np.random.default_rng(8)
    n, m = 60, 240
    a, b = rng.integers(0, n, m), rng.integers(0, n, m)
    keep = a != b
    a, b, w = np.minimum(a, b)[keep], np.maximum(a, b)[keep], rng.random(m)[keep]
    edges = spark.createDataFrame([(int(p), int(q), float(v)) for p, q, v in zip(a, b, w)], "a long, b long, ang double").groupBy("a", "b").min("ang").withColumnRenamed("min(ang)", "ang")
    members = spark.createDataFrame([(k, k, 0.0) for k in range(n)], "leader long, id long, ang float")
    from tesselon.llm.components import group_pairs
    from pyspark.sql import functions as F

    labels = group_pairs(edges.withColumn("s", F.lit("")), "s", "a", "b").selectExpr("vertex as node", "label")
    graph = D.Graph(members, edges, labels, 1.0)
    local = D.spanning_tree(graph).collect()
    rounds = D.spanning_tree(graph, local_edges=10).collect()
    assert len(local) == len(rounds) == n - len({r.label for r in labels.collect()}) - (n - labels.count())
    assert sum(r.w for r in local) == pytest.approx(sum(r.w for r in rounds))


def test_recall_at_the_limit(spark):
    rng = np.random.default_rng(9)
    a = rng.standard_normal((4_000, 32))
    a /= np.linalg.norm(a, axis=1, keepdims=True)
    b = rng.standard_normal(a.shape)
    b -= (b * a).sum(1, keepdims=True) * a
    t = np.arccos(0.95)
    b = np.cos(t) * a + np.sin(t) * b / np.linalg.norm(b, axis=1, keepdims=True)
    for n in (10_000, 1_000_000):
        tables = D.hashing(32, n, t)
        assert (tables.codes(a) == tables.codes(b)).any(1).mean() >= 0.97


def test_empty(spark):
    graph = D.neighbour_graph(spark.createDataFrame([], SCHEMA), "id", "x")
    assert D.similar_sets(graph, D.hierarchy(graph)).count() == 0
    rows, found = D.clusters(graph)
    assert rows.count() == 0 and found.count() == 0


def brute_clusters(ids, x, min_samples, limit=0.95):
    """Clusters by all pairs: components at every length of the mutual reachability graph, from the widest down."""
    q = np.rint(x.astype(np.float64) / np.linalg.norm(x.astype(np.float64), axis=1, keepdims=True) * 32767)
    v = q / np.linalg.norm(q, axis=1, keepdims=True)
    angle = np.arccos(limit)
    d = np.arccos(np.clip(v @ v.T, -1, 1))

    def components(rows, w, under):
        left, out = set(rows), []
        while left:
            todo, seen = [left.pop()], set()
            while todo:
                i = todo.pop()
                seen.add(i)
                near = {j for j in left if under(w[i, j])}
                left -= near
                todo += near
            out.append(sorted(seen))
        return out

    result = {}
    for rows in components(range(len(v)), d, lambda t: t <= angle):
        if len(rows) < 2:
            continue
        m = d[np.ix_(rows, rows)].copy()
        core = np.minimum([np.sort(np.delete(r, i))[min(min_samples - 1, len(rows) - 1) - 1] for i, r in enumerate(m)], angle)
        m = np.minimum(np.maximum(np.maximum(m, core[:, None]), core[None]), angle)
        leave = {}

        def walk(part, birth):
            stability, now = 0.0, part
            while len(now) > 1:
                widest = next(t for t in sorted({m[i, j] for i in now for j in now if i < j}, reverse=True) if len(components(now, m, lambda e: e < t)) > 1)
                level = max(1 / angle, 1 / max(widest, 1e-3))
                pieces = components(now, m, lambda e: e < widest)
                big = [p for p in pieces if len(p) > 1]
                for p in pieces:
                    if len(p) == 1:
                        leave[p[0]] = level
                        stability += level - birth
                if len(big) == 1:
                    now = big[0]
                    continue
                below = [walk(p, level) for p in big]
                stability += sum(len(p) for p in big) * (level - birth)
                if sum(s for s, _ in below) > stability:
                    return sum(s for s, _ in below), [c for _, cs in below for c in cs]
                break
            return stability, [(part, stability)]

        for part, stability in walk(list(range(len(rows))), 1 / angle)[1]:
            own = sorted((-leave[i], int(ids[rows[i]])) for i in part)
            result[min(i for _, i in own)] = (len(part), stability, [i for _, i in own[:3]])
    return result


@pytest.mark.parametrize("parts", [1, 7])
def test_clusters_are_those_of_the_records(spark, parts):
    x = np.concatenate([cloud(4, sets=(2, 3, 12, 70), singles=20), cloud(5, sets=(25, 25), singles=0, spread=0.3)])
    ids = np.random.default_rng(4).permutation(len(x)) + 10
    _, found = D.clusters(D.neighbour_graph(frame(spark, ids, x).repartition(parts), "id", "x"))
    got = {r["cluster"]: r for r in found.collect()}
    want = brute_clusters(ids, x, D.MIN_SAMPLES)
    assert got.keys() == want.keys()
    for cluster, (size, stability, exemplars) in want.items():
        assert got[cluster]["size"] == size and got[cluster]["exemplars"] == exemplars
        assert got[cluster]["stability"] == pytest.approx(stability, rel=1e-6, abs=1e-9)


def test_lone_records_fall_out_of_bubbles_at_their_edge(spark):
    x = cloud(6, sets=(40,), singles=0)
    rows, found = D.clusters(D.neighbour_graph(frame(spark, np.arange(len(x)), x), "id", "x"), exact=1)
    assert sum(r["size"] for r in found.collect()) == 40
    one = lambda *x: np.array(x)
    (part, _, leave, _), _ = D.fold(np.arange(4), one(1, 1, 1, 2), np.zeros(4), np.zeros(4), one(0, 0, 0), one(1, 3, 2), one(0.1, 0.2, 0.25), 0.3, 3, True)
    assert leave.tolist() == pytest.approx([5, 5, 4, 5]) and set(part) == {0}


@pytest.mark.parametrize("seed,least", [(0, 2), (1, 2), (2, 4)])
def test_rounds_fold_to_the_same(spark, seed, least):
    """Trees folded in rounds, a few nodes at a time, are those folded at once; equal lengths and bubbles among them."""
    rng = np.random.default_rng(seed)
    m = 80
    a = np.arange(1, m)
    b = np.array([rng.integers(max(0, k - 6), k) for k in a])
    w = np.round(rng.random(m - 1) * 0.3, 2) + 0.001
    n = np.where(rng.random(m) < 0.2, rng.integers(2, 9, m), 1)
    total = np.where(n >= least, n * rng.uniform(4, 40, m), 0.0)
    order = np.lexsort((b, a, w))
    (part, stability, leave, _), _ = D.fold(np.arange(m), n, total, np.zeros(m), a[order], b[order], w[order], 0.31, least, True)
    nodes = spark.createDataFrame([(7, k, int(n[k]), float(total[k]), 0.0) for k in range(m)], "tree long, node long, n long, total double, below double")
    edges = spark.createDataFrame([(7, int(p), int(q), float(d)) for p, q, d in zip(a, b, w)], "tree long, a long, b long, w double")
    got = {r.node: r for r in D.condense_trees(nodes, edges, 0.31, least, limit=30).collect()}
    assert len(got) == m and len(set(part)) > 2
    for k in range(m):
        assert (got[k].part if got[k].part is not None else D.NO_PART) == part[k]
        assert got[k].part is None or got[k].stability == pytest.approx(stability[k])
        assert got[k].leave == pytest.approx(leave[k], nan_ok=True)


@pytest.mark.parametrize("exact", [D.EXACT, 8])
def test_partitioning_plays_no_part(spark, exact):
    x = np.concatenate([cloud(11, sets=(2, 9, 80, 40), singles=60), cloud(12, sets=(60,), singles=0, spread=0.2)])
    ids = np.random.default_rng(11).permutation(len(x)) + 10
    found = []
    for parts in (1, 4, 16) if exact == D.EXACT else (1, 16):
        graph = D.neighbour_graph(frame(spark, ids, x).repartition(parts), "id", "x")
        rows = D.clusters(graph, exact=exact)[1].collect()
        sets = {tuple(r) for r in D.similar_sets(graph, D.hierarchy(graph, exact=exact)).collect()}
        assert sets == brute_sets(ids, x)
        found.append({(r["cluster"], r["size"], round(r["stability"], 6), tuple(r["exemplars"])) for r in rows})
    assert all(f == found[0] for f in found)


def test_links_at_the_limit_end_to_end(spark):
    """Pairs of records at a cosine of 0.951 among 3,000: nearly all become sets of two."""
    rng = np.random.default_rng(13)
    a = rng.standard_normal((1_500, 32))
    a /= np.linalg.norm(a, axis=1, keepdims=True)
    b = rng.standard_normal(a.shape)
    b -= (b * a).sum(1, keepdims=True) * a
    t = np.arccos(0.951)
    x = np.concatenate([a, np.cos(t) * a + np.sin(t) * b / np.linalg.norm(b, axis=1, keepdims=True)]).astype(np.float32)
    graph = D.neighbour_graph(frame(spark, np.arange(len(x)), x), "id", "x")
    got = {tuple(r) for r in D.similar_sets(graph, D.hierarchy(graph)).collect()}
    want = brute_sets(np.arange(len(x)), x)
    assert got <= want and len(got) >= 0.97 * len(want)


def test_crowded_buckets_and_cells_lose_nothing(spark, monkeypatch):
    x = cloud(14, sets=(3, 30, 120), singles=80)
    ids = np.arange(len(x))
    monkeypatch.setattr(D, "HOT", 5)
    monkeypatch.setattr(D, "CHUNK", 20)
    graph = D.neighbour_graph(frame(spark, ids, x), "id", "x")
    for exact in (D.EXACT, 4):
        assert {tuple(r) for r in D.similar_sets(graph, D.hierarchy(graph, exact=exact)).collect()} == brute_sets(ids, x)


def test_mutual_reachability_counts_five_records(spark):
    """Records all too far apart for bubbles: the way over bubbles gives the hierarchy of the records, too."""
    x = cloud(7, sets=(30, 24, 3), singles=0, spread=0.19)
    ids = np.random.default_rng(7).permutation(len(x)) + 10
    graph = D.neighbour_graph(frame(spark, ids, x), "id", "x")
    assert graph.members.where("n > 0").count() == len(x)
    want = brute_clusters(ids, x, 5)
    assert want != brute_clusters(ids, x, 2)
    for exact in (D.EXACT, 3):  # the three alone are fewer than min_samples, such trees are never of bubbles
        got = {r["cluster"]: (r["size"], r["stability"], r["exemplars"]) for r in D.clusters(graph, exact=exact)[1].collect()}
        assert {c: (r[0], r[2]) for c, r in got.items()} == {c: (r[0], r[2]) for c, r in want.items()}
        assert all(got[c][1] == pytest.approx(want[c][1], rel=1e-4, abs=1e-6) for c in want)


def test_sets_come_from_the_hierarchy(spark, sf_dir, monkeypatch):
    from tesselon.llm import queries as Q
    from tesselon.session import table

    made = []
    build = D.hierarchy
    monkeypatch.setattr(D, "hierarchy", lambda *a, **k: made.append(build(*a, **k)) or made[-1])
    got = {tuple(r) for r in Q.p4_found(spark, sf_dir).select("cell_uid", "cluster_uid").collect()}
    assert len(made) == 1
    cells = {r[0]: r[1] for r in table(spark, sf_dir, "integrated_cells").where("cell_uid is not null and size(x) = 32").select("cell_uid", "x").collect() if None not in r[1]}
    cells = {k: x for k, x in cells.items() if np.isfinite(x).all() and np.any(x)}
    assert got and got == brute_sets(np.array(list(cells)), np.array(list(cells.values())))
    roots = {r.id: r.tree for r in made[0].collect()}
    sets = {}
    for cell, cluster in got:
        sets.setdefault(roots[cell], set()).add(cluster)
    assert all(len(s) == 1 for s in sets.values())


def test_vectors_of_each_length_are_compared(spark):
    short = cloud(15, dims=8, sets=(4, 6), singles=10, spread=0.1)
    long = cloud(16, sets=(5, 7), singles=30)
    rows = [(k, [float(a) for a in r], "short", 0) for k, r in enumerate(short)] + [(5_000 + k, [float(a) for a in r], "long", 0) for k, r in enumerate(long)]
    rows += [(9_000, [1.0], "lone", 0)]
    graph = D.neighbour_graph(spark.createDataFrame(rows, SCHEMA).coalesce(1), "id", "x")
    want = brute_sets(np.arange(len(short)), short) | brute_sets(np.arange(len(long)) + 5_000, long)
    for exact in (D.EXACT, 3):
        assert {tuple(r) for r in D.similar_sets(graph, D.hierarchy(graph, exact=exact)).collect()} == want


@pytest.mark.parametrize("part", [D.EXACT, 16])
def test_size_of_a_tree_plays_no_part(spark, monkeypatch, part):
    """Trees cut in parts, bubbles, copies and chains among them, give what trees of one task give, to the last row."""
    rng = np.random.default_rng(17)
    x = np.concatenate([cloud(17, sets=(2, 3, 90, 60), singles=20), cloud(18, sets=(50, 45), singles=0, spread=0.3)])
    x = np.concatenate([x, x[rng.integers(0, len(x), 60)], np.repeat(x[:2], 7, axis=0)])
    a, b = np.linalg.qr(rng.standard_normal((32, 2)))[0].T
    t = np.deg2rad(np.arange(0, 180, 4) + rng.random(45))[:, None]
    x = np.concatenate([x, np.cos(t) * a + np.sin(t) * b]).astype(np.float32)
    ids = rng.permutation(len(x)) + 10
    twice = [(int(ids[k]), [float(c) for c in x[k] + 0.02], "twice", 1) for k in range(0, 80, 8)]
    graph = D.neighbour_graph(frame(spark, ids, x, twice), "id", "x")
    assert graph.members.where("n > 1").count() > 5
    monkeypatch.setattr(D, "PART", part, raising=False)
    found = []
    for exact in (D.EXACT, 1):
        rows = D.hierarchy(graph, exact=exact)
        clusters = D.clusters(graph, exact=exact)[1].collect()
        found.append((
            {(r.tree, r.node, r.id, r.part, r.strength and round(r.strength, 9), r.stability and round(r.stability, 6)) for r in rows.collect()},
            {tuple(r) for r in D.similar_sets(graph, rows).collect()},
            {(r.cluster, r["size"], round(r.stability, 6), tuple(r.exemplars)) for r in clusters},
        ))
    assert len(found[0][2]) > 8
    assert all(one == other for one, other in zip(*found))


def test_a_tree_that_one_task_can_take_is_shuffled_once(spark, monkeypatch):
    """A set of 2,600 records needs no pairs of parts, which lay out and shuffle its vectors several times."""
    monkeypatch.setattr(D, "_hierarchy_in_parts", lambda *a: pytest.fail("cut in parts"))
    x = cloud(19, sets=(2_600, 3), singles=5)
    graph = D.neighbour_graph(frame(spark, np.arange(len(x)), x), "id", "x")
    assert {tuple(r) for r in D.similar_sets(graph, D.hierarchy(graph)).collect()} == brute_sets(np.arange(len(x)), x)


def steps(x):
    return np.rint(x / np.linalg.norm(x, axis=1, keepdims=True) * 32767)


def trees():
    rng = np.random.default_rng(20)
    unit = lambda n, d=32: (lambda x: x / np.linalg.norm(x, axis=1, keepdims=True))(rng.standard_normal((n, d)))
    c, t = unit(1), np.sort(rng.random(500))[:, None]
    return {
        "copies": np.repeat(c + 0.1 * unit(60), rng.integers(1, 12, 60), axis=0),
        "one vector": np.repeat(c, 150, axis=0),
        "near equal": c + 0.002 * unit(400),
        "tight parts": np.repeat(c + 0.15 * unit(25), 20, axis=0) + 0.02 * unit(500),
        "two parts": np.repeat(c + 0.2 * unit(2), 250, axis=0) + 0.1 * unit(500),
        "a small dense part": np.concatenate([c + 0.25 * unit(1) + 0.1 * unit(900), c + 0.25 * unit(1) + 0.02 * unit(40)]),
        "chain": np.cos(t) * np.eye(32)[0] + np.sin(t) * np.eye(32)[1],
        "peaked": c + 0.2 * unit(1_200) * rng.random((1_200, 1)) ** 2,
        "few coordinates": unit(400, 3),
    }


@pytest.mark.parametrize("name", trees())
def test_trees_from_lists_are_those_of_all_pairs(name):
    v = steps(trees()[name])
    n, angle = len(v), np.arccos(0.95)
    s = D.cosines(v, v)
    others = np.sort(np.where(np.eye(n, dtype=bool), -2, s), axis=1)
    a, b, reach = D.dense_tree(v, others[:, n - 4], np.cos(angle))
    w = D._lengths(reach, angle)
    order = np.argsort(w, kind="stable")
    got = D.record_tree(v, angle, 5)
    assert np.array_equal(np.maximum(got[2], 1e-3), np.maximum(w[order], 1e-3)) and got[3] == pytest.approx(s.min(), abs=1e-15)
    fold = lambda a, b, w: D.fold(np.arange(n), np.ones(n, np.int64), np.zeros(n), np.zeros(n), a, b, w, angle, 2, True)[0]
    for one, other in zip(fold(*got[:3]), fold(a[order], b[order], w[order])):
        assert np.allclose(one, other, rtol=1e-9, atol=1e-9)


@pytest.mark.parametrize("n", [2, 3, 5, 30])
def test_trees_of_one_size_are_spanned_together(n):
    rng = np.random.default_rng(n)
    v = np.stack([steps(rng.standard_normal((1, 32)) + 0.2 * rng.standard_normal((n, 32))) for _ in range(7)])
    v[3, 1:3] = v[3, 0]
    a, b, w, lowest = D.small_trees(v, 0.3, 5)
    for k, x in enumerate(v):
        one = D.record_tree(x, 0.3, 5)
        assert np.array_equal(np.maximum(one[2], 1e-3), np.maximum(w[k], 1e-3)) and one[3] == pytest.approx(lowest[k], abs=1e-15)
        assert sorted({*a[k].tolist(), *b[k].tolist()}) == list(range(n))
