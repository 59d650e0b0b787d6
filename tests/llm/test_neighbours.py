import math

import numpy as np
from pyspark.sql import functions as F

from shelfcast.llm import forest, neighbours, queries

SCHEMA = "vec_id long, embedding array<float>"


def brute(rows, every, count):
    single: dict = {}
    for key, vector in (row[:2] for row in rows):
        if key is None or not vector or not all(v is not None and math.isfinite(v) for v in vector) or not any(vector):
            continue
        own = [float(np.float32(v)) for v in vector]
        single[key] = min(single.get(key, own), own)
    out = {}
    for key, own in single.items():
        if key % every == 0:
            scored = [(-float((np.array(own) * np.array(v)).sum()), other) for other, v in single.items() if other != key and len(v) == len(own)]
            out[key] = [(other, -score) for score, other in sorted(scored)[:count]]
    return {key: answer for key, answer in out.items() if answer}


def found(frame, rows, every, count, schema=SCHEMA, **more):
    result = neighbours.nearest(frame(rows, schema), F.col("vec_id") % every == 0, count, **more)
    out: dict = {}
    for query, rank, other, score in sorted(map(tuple, result.collect())):
        out.setdefault(query, []).append((other, score))
        assert rank == len(out[query])
    return out


def clustered(count, seed, width=16):
    chance = np.random.default_rng(seed)
    centres = chance.normal(size=(max(1, count // 20), width))
    rows = centres[np.arange(count) % len(centres)] + 0.4 * chance.normal(size=(count, width))
    rows /= np.linalg.norm(rows, axis=1, keepdims=True)
    return [(k, row.astype(np.float32).tolist()) for k, row in enumerate(rows)]


def recall(answer, truth):
    return sum(len({k for k, _ in answer.get(key, [])} & {k for k, _ in rows}) for key, rows in truth.items()) / sum(map(len, truth.values()))


def test_one_leaf_is_exact(frame):
    rows = clustered(300, 1)
    assert found(frame, rows, 7, 9) == brute(rows, 7, 9)


def test_recall_and_scores_of_a_deep_forest(frame, monkeypatch):
    monkeypatch.setattr(neighbours, "BLOCK_ROWS", 50)  # leaves lie in several blocks
    rows = clustered(3000, 2)
    truth, answer = brute(rows, 50, 20), found(frame, rows, 50, 20, leaf_rows=100)
    assert recall(answer, truth) >= 0.9
    plain = {key: np.array(vector, dtype=np.float32).astype(float) for key, vector in rows}
    for key, got in answer.items():
        assert got == sorted(got, key=lambda pair: (-pair[1], pair[0])) and len({k for k, _ in got}) == len(got) == 20
        assert all(abs(score - plain[key] @ plain[other]) < 1e-12 for other, score in got)


def test_a_bounded_sample_leaves_no_row_out(frame):
    rows = clustered(2000, 3)
    assert recall(found(frame, rows, 40, 20, leaf_rows=100, sample_rows=256), brute(rows, 40, 20)) >= 0.9


def test_a_third_of_all_rows_are_copies(frame):
    rows = clustered(600, 4) + [(1000 + k, [0.25] * 16) for k in range(300)]
    answer, truth = found(frame, rows, 20, 20, leaf_rows=100), brute(rows, 20, 20)
    assert recall(answer, truth) >= 0.9
    assert answer[1020] == truth[1020] and answer[1000] == truth[1000]  # ties of copies go to the least ids but one's own


def test_unusable_rows_repeats_and_rare_lengths(frame):
    nan, inf = float("nan"), float("inf")
    rows = [
        (0, [1.0, 0.0]), (1, [1.0, 0.0]), (2, [0.5, 0.5]), (3, [-1.0, 0.0]), (4, None), (5, []), (6, [0.0, 0.0]), (8, [nan, 1.0]), (10, [inf, 1.0]), (12, [1.0, None]), (None, [1.0, 1.0]),
        (14, [1.0, 1.0, 1.0]), (15, [1.0, 2.0, 1.0]), (16, [2.0]), (2, [0.25, 0.5]), (0, [1.0, 0.0]), (18, [-0.0, -3.0]),
    ]
    assert found(frame, rows, 2, 20) == brute(rows, 2, 20)


def test_clashing_columns_and_no_rows(frame):
    rows = [(*row, "a", 5, 6, 7) for row in clustered(80, 5)]
    assert found(frame, rows, 4, 3, SCHEMA + ", id string, block long, asked int, width int") == brute(rows, 4, 3)
    assert found(frame, [], 4, 3) == {}


def test_leaves_partition_the_rows():
    rows = np.random.default_rng(6).normal(size=(500, 8)).astype(np.float32)
    learned = forest.learn(rows, 500, 10, 3, 40, 0.95)
    for tree in learned.trees:
        assert set(tree.leaves(rows)) == set(range(1 << tree.depth))
    every = learned.visits([chances[0] for chances in learned.sides(rows[:1])], 1.1)
    assert len(every) == len(set(every)) == sum(1 << tree.depth for tree in learned.trees)


def test_query_against_brute_force(spark):
    folder = "/root/testdata/sf0.1"
    rows = [tuple(row) for row in spark.read.parquet(f"{folder}/embeddings.parquet").select("vec_id", "embedding").collect()]
    answer: dict = {}
    for query, _, other, score in sorted(map(tuple, queries.op12_neighbours(spark, folder).collect())):
        answer.setdefault(query, []).append((other, score))
    truth = brute(rows, 20, 20)
    assert answer.keys() == truth.keys() and recall(answer, truth) >= 0.9
