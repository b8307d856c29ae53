import random

import numpy as np

from crewspark.llm.common import connected_components
from crewspark.llm.minhash import least_matches, near_duplicates
from crewspark.llm.vectors import near_duplicate_vectors


def components(nodes, edges):
    root = {n: n for n in nodes}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    for a, b in edges:
        x, y = find(a), find(b)
        root[max(x, y)] = min(x, y)
    return {n: find(n) for n in nodes}


def test_components_of_random_graph_over_partitions(frame):
    rnd = random.Random(1)
    edges = [(rnd.randrange(400), rnd.randrange(400)) for _ in range(260)] + [(i, i + 1) for i in range(1000, 1100)] + [(None, 3), (7, None), (9, 9)]
    real = [(a, b) for a, b in edges if a is not None and b is not None and a != b]
    want = components({x for e in real for x in e}, real)
    got = connected_components(frame(edges, "a long, b long", 7))
    assert {r["id"]: r["component"] for r in got.collect()} == want
    assert connected_components(frame([], "a long, b long")).count() == 0


def brute_texts(rows, k, num, den):
    sets = {}
    for i, t in rows:
        w = (t or "").encode().lower().split()
        sets[i] = set(zip(*(w[j:] for j in range(k)))) if len(w) >= k else {tuple(w)} if w else set()
    ids = sorted(sets)
    edges = [(a, b) for n, a in enumerate(ids) for b in ids[n + 1:] if sets[a] and sets[b] and den * len(sets[a] & sets[b]) >= num * len(sets[a] | sets[b])]
    comp = components(ids, edges)
    return {(i, len(sets[i]), comp[i], comp[i] == i) for i in ids}


def test_minhash_equals_brute_force(frame):
    rnd = random.Random(2)
    word = lambda: rnd.choice("abcdefghij") + rnd.choice("klmnopqrst") + str(rnd.randrange(30))
    rows, base = [], [word() for _ in range(120)]
    for i in range(40):  # near copies at many distances of one text, and a chain of copies of copies
        t = list(base)
        for _ in range(i % 9):
            t[rnd.randrange(len(t))] = word()
        rows.append((i, " ".join(t)))
    for i in range(40, 60):
        base = list(base)
        for _ in range(3):
            base[rnd.randrange(len(base))] = word()
        rows.append((i, "\n".join(base)))
    rows += [(i, " ".join(word() for _ in range(rnd.randrange(1, 60)))) for i in range(60, 100)]
    rows += [(100, None), (101, ""), (102, " \t\n"), (103, "Two words"), (104, "two WORDS"), (105, "a b c"), (106, "A  b\x0bc"), (107, "one"), (108, "x y z w"), (109, "word " * 60_000)]
    rows += [(200 + i, rows[5][1]) for i in range(5)]
    got = near_duplicates(frame([(i, t, "x", 0) for i, t in rows], "doc_id long, text string, digest string, n long"), block=8)
    assert {tuple(r) for r in got.collect()} == brute_texts(rows, 3, 85, 100)


def test_minhash_edges(frame):
    assert near_duplicates(frame([], "doc_id long, text string")).count() == 0
    got = near_duplicates(frame([(None, "a b c d"), (4, "a b c d"), (4, "a b c d"), (None, None)], "doc_id long, text string")).collect()
    assert sorted(tuple(r) for r in got if r[0] is not None) == [(4, 2, 4, True)] * 2
    assert [(r["component_id"], r["kept"]) for r in got if r["doc_id"] is None] == [(None, False)] * 2


def test_pruning_keeps_similar_pairs():
    steps = least_matches(150, 30, 0.85, 1e-6)
    assert [n for n, _ in steps] == [30, 60, 90, 120, 150]
    rng = np.random.default_rng(0)
    same = rng.random((20_000, 150)) < 0.85
    alive = np.ones(len(same), bool)
    for n, need in steps:
        alive &= same[:, :n].sum(1) >= need
    assert (~alive).sum() <= 2
    assert steps[-1][1] > 90


def brute_vectors(rows, threshold=0.98):
    ok = {}
    for i, label, e in rows:
        if label is None or e is None or not e or any(x is None or not np.isfinite(x) for x in e) or not any(e):
            continue
        ok[i] = (label, np.array(e, float) / max(abs(x) for x in e))
    ids = sorted(ok)
    edges = []
    for n, a in enumerate(ids):
        for b in ids[n + 1:]:
            x, y = ok[a][1], ok[b][1]
            if ok[a][0] == ok[b][0] and len(x) == len(y) and x @ y / (np.sqrt(x @ x) * np.sqrt(y @ y)) >= threshold:
                edges.append((a, b))
    comp = components([r[0] for r in rows], edges)
    n = {r[0]: sum(r[0] in e for e in edges) for r in rows}
    return {(r[0], n[r[0]], comp[r[0]], comp[r[0]] == r[0]) for r in rows}


def test_vectors_equal_brute_force(frame):
    rng = np.random.default_rng(3)
    rows = []
    for i in range(150):
        centre = np.random.default_rng(i % 12).normal(size=16)
        rows.append((i, int(i % 3), (centre + rng.normal(size=16) * rng.choice([0, 0.05, 0.2])).tolist()))
    rows += [(200, 1, None), (201, 1, []), (202, 1, [0.0] * 16), (203, 1, [None] + [1.0] * 15), (204, 1, [float("nan")] * 16), (205, None, rows[1][2]), (206, 1, rows[1][2]),
             (207, 1, [1.0, 2.0]), (208, 1, [2.0, 4.0]), (209, 1, [1e-300, 2e-300]), (210, 1, [1e300, 2e300]), (211, 1, [float("inf"), 1.0])]
    got = near_duplicate_vectors(frame([(*r, "x", 5) for r in rows], "vec_id long, label int, embedding array<double>, code string, n_links long"), block=16)
    assert {tuple(r) for r in got.collect()} == brute_vectors(rows)


def test_vector_edges(frame):
    schema = "vec_id long, label int, embedding array<float>"
    assert near_duplicate_vectors(frame([], schema)).count() == 0
    got = {tuple(r) for r in near_duplicate_vectors(frame([(1, 1, [1.0, 0.0]), (1, 1, [1.0, 0.0]), (2, 1, [1.0, 0.01]), (None, 1, [1.0, 0.0])], schema)).collect()}
    assert got == {(1, 1, 1, True), (2, 1, 1, False), (None, 0, None, None)}
