import numpy as np

from shelfcast.llm import vectors


def brute(rows, threshold):
    """Links and components by comparing all pairs."""
    links, parent = [0] * len(rows), list(range(len(rows)))

    def root(k):
        while parent[k] != k:
            k = parent[k]
        return k

    def usable(row):
        key, vector, label = row
        return key is not None and label is not None and vector and None not in vector and np.isfinite(np.array(vector, dtype=float)).all() and any(vector)

    for a, x in enumerate(rows):
        for b, y in enumerate(rows[:a]):
            if usable(x) and usable(y) and x[2] == y[2] and len(x[1]) == len(y[1]):
                u, v = np.array(x[1], dtype=np.float32).astype(float), np.array(y[1], dtype=np.float32).astype(float)
                if u @ v / np.sqrt(u @ u) / np.sqrt(v @ v) >= threshold:
                    links[a], links[b] = links[a] + 1, links[b] + 1
                    p, q = root(a), root(b)
                    parent[max(p, q)] = min(p, q)
    least = {}
    for k, row in enumerate(rows):
        if row[0] is not None:
            least[root(k)] = min(least.get(root(k), row[0]), row[0])
    return [(row[0], links[k], least.get(root(k)), row[0] is None or row[0] == least[root(k)]) for k, row in enumerate(rows)]


def found(frame, rows, **more):
    result = vectors.near_vectors(frame(rows, "vec_id long, embedding array<float>, label int, kept string" if rows and len(rows[0]) == 4 else "vec_id long, embedding array<float>, label int"), **more)
    return sorted(map(tuple, result.collect()), key=str)


def cluster(count, seed, spread, width=24):
    chance = np.random.default_rng(seed)
    centres = chance.normal(size=(max(1, count // 12), width))
    return [(centres[k % len(centres)] + spread * chance.normal(size=width)).astype(np.float32).tolist() for k in range(count)]


def test_equals_all_pairs(frame, monkeypatch):
    monkeypatch.setattr(vectors, "TILE_ROWS", 40)
    rows = [(k, vector, k % 2) for k, vector in enumerate(cluster(260, 3, 0.25))]
    assert found(frame, rows) == sorted(brute(rows, 0.93), key=str)


def test_copies_and_unusable_vectors(frame):
    same = [1.0, 2.0, 3.0]
    rows = [
        (1, same, 0), (2, same, 0), (3, same, 0), (4, [2.0, 4.0, 6.0], 0), (5, same, 1), (6, None, 0), (7, [0.0, 0.0, 0.0], 0), (8, [1.0, None, 3.0], 0),
        (9, [float("nan"), 1.0, 1.0], 0), (10, [float("inf"), 1.0, 1.0], 0), (11, same, None), (12, [], 0), (13, [1.0, 2.0], 0), (None, same, 0), (14, [-1.0, -2.0, -3.0], 0),
    ]
    assert found(frame, rows) == sorted(brute(rows, 0.93), key=str)


def test_a_chain_is_one_component(frame):
    angle = np.arccos(0.94)
    rows = [(k, [float(np.cos(k * angle)), float(np.sin(k * angle))], 0) for k in range(9)]
    assert found(frame, rows) == sorted(brute(rows, 0.93), key=str)


def test_no_vectors(frame):
    assert found(frame, []) == []
