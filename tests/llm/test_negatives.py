import math

import duckdb
import numpy as np
from pyspark.sql import functions as F

from shelfcast.llm import negatives, queries

SCHEMA = "vec_id long, embedding array<float>, label int"


def fits(row):
    key, vector, label = row[:3]
    return key is not None and label is not None and vector and all(v is not None and math.isfinite(v) for v in vector)


def brute(rows, every, positives=5, count=3, low=50, high=95):
    single: dict = {}
    for row in filter(fits, rows):
        vector = [float(np.float32(v)) for v in row[1]]
        single[row[0]] = min(single.get(row[0], (row[2], vector)), (row[2], vector))
    whole = {key: (label, [math.floor(256 * v) for v in vector]) for key, (label, vector) in single.items()}
    out = []
    for anchor, (label, own) in whole.items():
        if anchor % every:
            continue
        scored = sorted((-sum(a * b for a, b in zip(own, v, strict=True)), key, of) for key, (of, v) in whole.items() if key != anchor and len(v) == len(own))
        for p, key, _ in [row for row in scored if row[2] == label][:positives]:
            window = [row for row in scored if row[2] != label and low * -p <= 100 * -row[0] <= high * -p]
            out += [(anchor, key, rank, other, -p, -n) for rank, (n, other, _) in enumerate(window[:count], 1)]
    return sorted(out)


def found(frame, rows, every, schema=SCHEMA, **more):
    result = negatives.hard_negatives(frame(rows, schema), F.col("vec_id") % every == 0, **more)
    return sorted(map(tuple, result.collect()))


def vectors(count, seed, width=16):
    chance = np.random.default_rng(seed)
    plain = chance.normal(size=(count, width)) / math.sqrt(width)
    return [(k, plain[k].astype(np.float32).tolist(), int(chance.integers(0, 4))) for k in range(count)]


def test_equals_all_pairs(frame):
    rows = vectors(400, 1)
    assert found(frame, rows, 5) == brute(rows, 5)


def test_many_tiles_and_blocks_give_the_same(frame, monkeypatch):
    monkeypatch.setattr(negatives, "TILE_ROWS", 16)
    monkeypatch.setattr(negatives, "TILES", 1000)
    monkeypatch.setattr(negatives, "_ROWS", 5)
    monkeypatch.setattr(negatives, "_ANCHORS", 3)
    rows = vectors(260, 2)
    assert found(frame, rows, 3) == brute(rows, 3)


def test_a_third_of_all_rows_are_copies(frame, monkeypatch):
    monkeypatch.setattr(negatives, "TILE_ROWS", 32)
    rows = vectors(180, 3) + [(1000 + k, [0.25] * 16, k % 4) for k in range(90)]
    assert found(frame, rows, 10) == brute(rows, 10)


def test_ties_zero_scores_unusable_rows_and_repeats(frame):
    nan, inf = float("nan"), float("inf")
    rows = [
        (0, [1.0, 0.0], 1), (1, [0.0, 1.0], 1), (2, [0.0, -1.0], 2), (3, [0.0, 0.5], 2), (4, [1.0, 1.0], 1), (5, [0.5, 0.0], 3), (6, [0.5, 9.0], 3), (7, [0.5, 0.1], 2),
        (8, None, 1), (9, [nan, 1.0], 2), (10, [inf, 1.0], 2), (11, [None, 1.0], 2), (12, [1.0, 1.0], None), (None, [1.0, 1.0], 2), (13, [], 1), (14, [1.0], 2), (15, [0.75], 1), (30, [1.0], 1),
        (4, [1.0, 1.0], 1), (7, [0.25, 0.1], 2), (20, [0.0, 0.0], 1), (10, [0.1, 0.2], 1),
    ]
    assert found(frame, rows, 5) == brute(rows, 5)
    assert found(frame, rows, 1) == brute(rows, 1)


def test_components_beyond_exact_floats(frame):
    rows = [(k, [float(1 + k) * 1e6, 3e6 - k, 2e6], k % 2) for k in range(12)]
    assert found(frame, rows, 3) == brute(rows, 3)
    beyond = [(k, [3e38, 1e30 * k], k % 2) for k in range(4)]  # products are cut at 64 bits
    assert found(frame, beyond, 2) == []


def test_clashing_columns_and_no_rows(frame):
    rows = [(*row, "a", 1, 2) for row in vectors(60, 4)]
    assert found(frame, rows, 4, SCHEMA + ", side string, block long, anchor int") == brute(rows, 4)
    assert found(frame, [], 4) == []


def test_query_equals_its_twin(spark):
    folder = "/root/testdata/sf0.001"
    sql = duckdb.connect()
    sql.sql(f"CREATE VIEW embeddings AS SELECT * FROM '{folder}/embeddings.parquet'")
    result = queries.op13_hard_negatives(spark, folder)
    assert sorted(map(tuple, result.collect())) == sorted(sql.sql(negatives.oracle_sql()).project(", ".join(result.columns)).fetchall())
