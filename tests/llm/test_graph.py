import random

from shelfcast.llm.graph import components


def test_paths_stars_and_loops(frame):
    chance = random.Random(4)
    edges = [(k, k + 1) for k in range(60)] + [(100, k) for k in range(101, 160)] + [(200, 200)] + [(300 + chance.randrange(40), 300 + chance.randrange(40)) for _ in range(50)]
    chance.shuffle(edges)
    parent = {}

    def root(k):
        while parent.setdefault(k, k) != k:
            k = parent[k]
        return k

    for a, b in edges:
        if a != b:
            p, q = root(a), root(b)
            parent[max(p, q)] = min(p, q)
    expected = {k: root(k) for k in list(parent)}
    assert {row["node"]: row["component"] for row in components(frame(edges, "a long, b long")).collect()} == expected


def test_no_edges(frame):
    assert components(frame([], "a long, b long")).count() == 0
