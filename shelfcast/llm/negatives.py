"""Hard negatives: near rows of another label that stay a margin below an anchor's positives.

Integer scores of anchors against all rows are made tile by tile.  A tile hands on only what an answer can hold: its
best rows of the anchor's label, then, with the anchor's positives known, its best rows of other labels within the
window of each.  These pairs are dealt by anchor and sorted by (anchor, descending score, id) in the shuffle; an
iterator walks them, opens a window at each positive and emits negatives as they pass.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelfcast.llm.blocks import longs, matrix, meet, top, usable
from shelfcast.llm.shared import map_batches, materialise, ship_code

#: Rows of a tile: at least, tiles that a table is dealt into before tiles grow, and bytes of 4-byte components at most.
TILE_ROWS, TILES, TILE_BYTES = 4096, 64, 64 << 20
_ANCHORS, _ROWS = 256, 8192
_MOST = (1 << 63) - 1


def _integers(vectors: np.ndarray, scale: int) -> np.ndarray:
    return np.clip(np.floor(scale * vectors.astype(np.float64)), -1e300, 1e300)


def _products(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Exact inner products as 64-bit integers; beyond their range the largest or smallest."""
    bound = float(np.sqrt((left**2).sum(axis=1).max()) * np.sqrt((right**2).sum(axis=1).max()))
    if bound < 1 << 24:  # all partial sums are exact in single precision
        return (left.astype(np.float32) @ right.astype(np.float32).T).astype(np.int64)
    if bound < 1 << 53:
        return (left @ right.T).astype(np.int64)
    whole = [[int(x) for x in row] for row in left], [[int(x) for x in row] for row in right]
    return np.array([[max(-_MOST, min(_MOST, sum(x * y for x, y in zip(a, b, strict=True)))) for b in whole[1]] for a in whole[0]], dtype=np.int64)


def _tile(scale: int):
    def prepare(table: pa.Table) -> dict[str, np.ndarray]:
        ids, labels = longs(table, "id"), longs(table, "label")
        order = np.lexsort((ids, labels))
        return {"id": ids[order], "label": labels[order], "vector": _integers(matrix(table.column("vector"))[order], scale).astype(np.float64)}

    return prepare


def _pairs(anchors: list, ids: list, scores: list) -> pa.RecordBatch:
    columns = [np.concatenate(part) if part else np.zeros(0, dtype=np.int64) for part in (anchors, ids, scores)]
    return pa.RecordBatch.from_arrays([pa.array(column, pa.int64()) for column in columns], names=["anchor", "id", "score"])


def _positives(scale: int, count: int):
    def work(tile: dict[str, np.ndarray], batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        ids, labels, vectors = longs(batch, "id"), longs(batch, "label"), _integers(matrix(batch.column("vector")), scale)
        out: tuple[list, list, list] = ([], [], [])
        for label in np.unique(labels):
            first, last = np.searchsorted(tile["label"], label, "left"), np.searchsorted(tile["label"], label, "right")
            mine = np.flatnonzero(labels == label)
            for a in range(0, len(mine) if last > first else 0, _ANCHORS):
                some = mine[a : a + _ANCHORS]
                for b in range(first, last, _ROWS):
                    others = tile["id"][b : min(last, b + _ROWS)]
                    scores = _products(vectors[some], tile["vector"][b : b + len(others)])
                    own = others[None, :] == ids[some][:, None]
                    row, column = top(np.where(own, -_MOST - 1, scores), count)
                    keep = ~own[row, column]
                    row, column = row[keep], column[keep]
                    for part, values in zip(out, (ids[some][row], others[column], scores[row, column]), strict=True):
                        part.append(values)
        yield _pairs(*out)

    return work


def _negatives(scale: int, count: int):
    def work(tile: dict[str, np.ndarray], batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        ids, labels, vectors = longs(batch, "id"), longs(batch, "label"), _integers(matrix(batch.column("vector")), scale)
        lows, highs = batch.column("lows").to_pylist(), batch.column("highs").to_pylist()
        out: tuple[list, list, list] = ([], [], [])
        for a in range(0, len(ids), _ANCHORS):
            some = slice(a, min(len(ids), a + _ANCHORS))
            least, most = np.array([min(x) for x in lows[some]]), np.array([max(x) for x in highs[some]])
            for b in range(0, len(tile["id"]), _ROWS):
                scores = _products(vectors[some], tile["vector"][b : b + _ROWS])
                fits = (scores >= least[:, None]) & (scores <= most[:, None]) & (tile["label"][b : b + _ROWS] != labels[some][:, None])
                row, column = np.nonzero(fits)
                value, other = scores[row, column], tile["id"][b : b + _ROWS][column]
                order = np.lexsort((other, -value, row))
                row, value, other = row[order], value[order], other[order]
                starts = np.searchsorted(row, np.arange(some.stop - a + 1))
                taken: list[np.ndarray] = []
                for r in range(some.stop - a):
                    down = -value[starts[r] : starts[r + 1]]
                    for low, high in zip(lows[a + r], highs[a + r], strict=True):
                        at = np.searchsorted(down, -high, "left")
                        end = min(at + count, np.searchsorted(down, -low, "right"))
                        taken.append(np.arange(at, end) + starts[r])
                chosen = np.unique(np.concatenate(taken)) if taken else np.zeros(0, dtype=np.int64)
                for part, values in zip(out, (ids[some][row[chosen]], other[chosen], value[chosen]), strict=True):
                    part.append(values)
        yield _pairs(*out)

    return work


def _walk(positives: int, negatives: int, low: int, high: int):
    """Sorted pairs (anchor, id, score, kind) to (anchor, positive, rank, negative, scores); holds the open windows only."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, seen, windows = None, 0, []
        for batch in batches:
            out: list[tuple] = []
            for anchor, other, score, kind in zip(*(batch.column(name).to_pylist() for name in ("anchor", "id", "score", "kind")), strict=True):
                if anchor != now:
                    now, seen, windows = anchor, 0, []
                if kind == 0:
                    if seen < positives:
                        seen += 1
                        windows.append([other, score, 0])
                    continue
                for window in windows:
                    if window[2] < negatives and low * window[1] <= 100 * score <= high * window[1]:
                        window[2] += 1
                        out.append((anchor, window[0], window[2], other, window[1], score))
                windows = [window for window in windows if window[2] < negatives and 100 * score >= low * window[1]]
            columns = zip(*out, strict=True) if out else [[] for _ in range(6)]
            kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
            names = ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
            yield pa.RecordBatch.from_arrays([pa.array(column, of) for column, of in zip(columns, kinds, strict=True)], names=names)

    return run


def hard_negatives(
    rows: DataFrame, anchors: F.Column, key: str = "vec_id", vector: str = "embedding", label: str = "label",
    positives: int = 5, negatives: int = 3, low: int = 50, high: int = 95, scale: int = 256,
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score) for the rows that ``anchors`` names.

    A score is the inner product of components floor(scale * x); products beyond 64 bits count as the largest or
    smallest.  An anchor's positives are its first ``positives`` other rows of its label by descending score, then
    id; each gives its first ``negatives`` rows of other labels with low*p <= 100*n <= high*p, none if there are none.

    Rows without a key or label, and vectors that are null, empty or hold a null or non-finite component, take no part.
    A key that comes more than once counts once, with its least (label, vector).  Vectors of different lengths have no
    score.  ``anchors`` is a condition on the columns of ``rows``, of which no others are read; an empty table gives
    no rows.
    """
    ship_code(rows.sparkSession)
    valid = rows.select(F.col(key).cast("long").alias("id"), F.col(label).cast("long").alias("label"), F.col(vector).alias("vector"), F.coalesce(anchors, F.lit(False)).alias("anchor"))
    valid = valid.where(F.col("id").isNotNull() & F.col("label").isNotNull() & usable("vector"))
    single = valid.groupBy("id").agg(F.min(F.struct("label", "vector", "anchor")).alias("row")).select("id", "row.*").withColumn("width", F.size("vector"))
    single = materialise(single)
    amounts = single.groupBy("width").agg(F.count("*").alias("n"))
    per_tile = F.greatest(F.lit(1), F.least(F.floor(TILE_BYTES / (4 * F.col("width"))), F.greatest(F.lit(TILE_ROWS), F.ceil(F.col("n") / TILES))))
    amounts = amounts.select("width", F.ceil(F.col("n") / per_tile).cast("long").alias("tiles"))
    sized = single.join(amounts, "width")
    base = F.shiftleft(F.col("width").cast("long"), 32)
    tiles = sized.select("id", "label", "vector", (base + F.pmod(F.xxhash64("id"), F.col("tiles"))).alias("block"))
    asking = sized.where("anchor").select("id", "label", "vector", F.explode(F.sequence(F.lit(0).cast("long"), F.col("tiles") - 1)).alias("tile"), base.alias("base"))
    asking = asking.withColumn("block", F.col("base") + F.col("tile")).drop("base", "tile")
    pair = "anchor long, id long, score long"
    best = Window.partitionBy("anchor").orderBy(F.desc("score"), "id")
    first = meet(tiles, asking, _tile(scale), _positives(scale, positives), pair)
    first = materialise(first.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= positives).drop("rank"))

    exact = F.col("score").cast("decimal(25,0)")
    windows = first.select(
        F.col("anchor").alias("id"),
        F.ceil(exact * low / 100).cast("long").alias("lo"),
        F.floor(exact * high / 100).cast("long").alias("hi"),
    ).where("lo <= hi")
    windows = windows.groupBy("id").agg(F.collect_list(F.struct("lo", "hi")).alias("w")).select("id", F.col("w.lo").alias("lows"), F.col("w.hi").alias("highs"))
    second = meet(tiles, asking.join(windows, "id"), _tile(scale), _negatives(scale, negatives), pair)
    both = first.withColumn("kind", F.lit(0)).unionByName(second.withColumn("kind", F.lit(1)))
    dealt = both.repartition("anchor").sortWithinPartitions("anchor", F.desc("score"), "kind", "id")
    return map_batches(dealt, _walk(positives, negatives, low, high), "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long")


def oracle_sql() -> str:
    """DuckDB SQL of the registered query: all pairs of anchors and rows."""
    return """
    WITH r AS (
      SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
      FROM embeddings
      WHERE vec_id IS NOT NULL AND label IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    ), p AS (
      SELECT a.vec_id AS anchor_id, r.vec_id AS other, r.label = a.label AS same, CAST(list_dot_product(a.v, r.v) AS BIGINT) AS score
      FROM r AS a JOIN r ON a.vec_id % 50 = 0 AND r.vec_id <> a.vec_id
    ), q AS (
      SELECT anchor_id, other AS positive_id, score AS positive_score FROM p WHERE same
      QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other) <= 5
    ), n AS (
      SELECT q.anchor_id, positive_id, CAST(row_number() OVER (PARTITION BY q.anchor_id, positive_id ORDER BY p.score DESC, p.other) AS INTEGER) AS rank,
        p.other AS negative_id, positive_score, p.score AS negative_score
      FROM q JOIN p ON p.anchor_id = q.anchor_id AND NOT p.same AND 50 * positive_score <= 100 * p.score AND 100 * p.score <= 95 * positive_score
    )
    SELECT * FROM n WHERE rank <= 3
    """
