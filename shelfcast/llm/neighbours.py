"""Approximate nearest neighbours by largest inner product: a forest of random-projection trees, reranked exactly.

The trees are learned from a bounded sample; every vector is indexed in one leaf of each tree.  Equal vectors are one
entry of the index.  A query takes leaves of all trees from one queue, best first, until a neighbour has been met with
a wanted probability; in each leaf it is compared with all rows in double precision.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelfcast.llm import forest
from shelfcast.llm.blocks import longs, matrix, meet, top, usable
from shelfcast.llm.shared import map_batches, materialise, ship_code

#: The index is learned from so many vectors at most, and from so many bytes of them.
SAMPLE, SAMPLE_BYTES = 65536, 16 << 20
#: Trees, rows that a leaf holds at least (about), and the probability with which a neighbour is to be met.
TREES, LEAF_ROWS, WANTED = 8, 1024, 0.96
#: Rows of a block: a larger leaf is compared in several.
BLOCK_ROWS = 32768
#: Results that a task holds to combine those of the same query.
HELD_ROWS = 400_000
_QUERIES = 256
#: Block numbers: tree, leaf and part of a leaf; vectors of another length than most are in one leaf per length.
_PARTS, _LEAVES = 20, 20


def _number(tree: int | np.ndarray, leaf: np.ndarray) -> np.ndarray:
    return (np.int64(tree) << _LEAVES) + leaf


def _counted(trees: forest.Forest, width: int):
    """Rows (leaf, n): how many vectors of a batch lie in each leaf."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = np.concatenate(_leaves(trees, width, batch)[1])
            leaves, counts = np.unique(found, return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(leaves, pa.int64()), pa.array(counts, pa.int64())], names=["leaf", "n"])

    return run


def _leaves(trees: forest.Forest, width: int, batch: pa.RecordBatch) -> tuple[np.ndarray, list[np.ndarray]]:
    """Which rows have the usual length, and the leaves of all rows, tree by tree; other rows have one leaf."""
    widths = longs(batch, "width")
    usual = widths == width
    if not usual.any():
        return usual, [-widths.astype(np.int64)]
    vectors = matrix(batch.column("vector").filter(pa.array(usual))).astype(np.float32)
    return usual, [_number(k, tree.leaves(vectors)) for k, tree in enumerate(trees.trees)] + [-widths[~usual].astype(np.int64)]


def _placed(trees: forest.Forest, width: int, parts: dict[int, int]):
    """Each row once for each tree, with its block."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            usual, found = _leaves(trees, width, batch)
            inside, outside = np.flatnonzero(usual), np.flatnonzero(~usual)
            for k, leaves in enumerate(found):
                rows = batch.take(pa.array(outside if k == len(found) - 1 else inside))
                part = longs(rows, "id") % np.array([parts[leaf] for leaf in leaves.tolist()], dtype=np.int64) if len(leaves) else leaves
                yield pa.RecordBatch.from_arrays([pa.array((leaves << _PARTS) + part, pa.int64()), rows.column("id"), rows.column("vector")], names=["block", "id", "vector"])

    return run


def _visiting(trees: forest.Forest, width: int, parts: dict[int, int], wanted: float):
    """Each query once for each block that it visits."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for start in range(0, whole.num_rows, _QUERIES):
                batch = whole.slice(start, _QUERIES)
                usual = longs(batch, "width") == width
                chances = trees.sides(matrix(batch.column("vector").filter(pa.array(usual))).astype(np.float32)) if usual.any() else []
                rows, blocks, seen = [], [], 0
                for row, (is_usual, own) in enumerate(zip(usual, longs(batch, "width"), strict=True)):
                    leaves = [-int(own)]
                    if is_usual:
                        leaves = [int(_number(tree, leaf)) for tree, leaf in trees.visits([chance[seen] for chance in chances], wanted)]
                        seen += 1
                    for leaf in leaves:
                        some = [(leaf << _PARTS) + part for part in range(parts.get(leaf, 0))]
                        blocks += some
                        rows += [row] * len(some)
                taken = batch.take(pa.array(rows, pa.int64()))
                yield pa.RecordBatch.from_arrays([pa.array(blocks, pa.int64()), taken.column("id"), taken.column("vector")], names=["block", "id", "vector"])

    return run


def _block(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    ids = longs(table, "id")
    order = np.argsort(ids, kind="stable")
    return ids[order], matrix(table.column("vector"))[order].astype(np.float64)


def _best(count: int):
    """The ``count`` best rows of a block for each query, with their inner products in double precision."""

    def work(block: tuple[np.ndarray, np.ndarray], batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        ids, vectors = block
        for start in range(0, batch.num_rows, _QUERIES):
            part = batch.slice(start, _QUERIES)
            queries, asked = matrix(part.column("vector")).astype(np.float64), longs(part, "id")
            row, column = top(queries @ vectors.T, count)
            scores = (queries[row] * vectors[column]).sum(axis=1)
            yield pa.RecordBatch.from_arrays([pa.array(asked[row]), pa.array(ids[column]), pa.array(scores, pa.float64())], names=["query", "id", "score"])

    return work


def _combined(count: int):
    """The ``count`` best of each query among the rows that a task has made, kept in HELD_ROWS rows."""

    def least(held: list[pa.RecordBatch]) -> pa.RecordBatch:
        rows = pa.Table.from_batches(held).combine_chunks()
        query, other, score = longs(rows, "query"), longs(rows, "id"), longs(rows, "score")
        order = np.lexsort((other, -score, query))
        query, other, score = query[order], other[order], score[order]
        once = np.ones(len(query), dtype=bool)  # a row that was met in several trees has the same score in all
        once[1:] = (query[1:] != query[:-1]) | (other[1:] != other[:-1])
        query, other, score = query[once], other[once], score[once]
        place = np.arange(len(query)) - np.searchsorted(query, query, "left")
        best = place < count
        return pa.RecordBatch.from_arrays([pa.array(query[best]), pa.array(other[best]), pa.array(score[best])], names=["query", "id", "score"])

    def combine(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, amount = [], 0
        for batch in batches:
            held.append(batch)
            amount += batch.num_rows
            if amount > HELD_ROWS:
                held = [least(held)]
                amount = held[0].num_rows
                if amount > HELD_ROWS // 2:
                    yield held.pop()
                    amount = 0
        if held:
            yield least(held)

    return combine


def nearest(
    rows: DataFrame, queries: F.Column, neighbours: int = 20, key: str = "vec_id", vector: str = "embedding",
    trees: int = TREES, leaf_rows: int = LEAF_ROWS, wanted: float = WANTED, sample_rows: int = SAMPLE,
) -> DataFrame:
    """(query_id, rank, <key>, score): for each row that ``queries`` names its nearest other rows by inner product.

    ``queries`` is a condition on the key's column.  Ranks go by descending score, then key.  Rows whose key is null and
    vectors that are null, empty, zero or hold a null or non-finite component take no part; vectors of different lengths
    are not compared, and those of a rarer length are compared with all of theirs.  A key that comes more than once counts
    once, with its least vector.  Equal vectors have equal scores and all their keys may be returned.  Columns but the
    key and the vector are not read; an empty table gives no rows.
    """
    ship_code(rows.sparkSession)
    valid = rows.select(F.col(key).cast("long").alias("id"), F.col(vector).alias("vector"), F.coalesce(queries, F.lit(False)).alias("asked"))
    valid = valid.where(F.col("id").isNotNull() & usable("vector") & F.exists("vector", lambda v: v != 0))
    single = materialise(valid.groupBy("id").agg(F.min("vector").alias("vector"), F.max("asked").alias("asked")))

    # equal vectors: the least id stands for all, the first neighbours + 1 ids are all that an answer can need
    members = single.withColumn("place", F.row_number().over(Window.partitionBy("vector").orderBy("id"))).where(F.col("place") <= neighbours + 1)
    classes = members.groupBy("vector").agg(F.sort_array(F.collect_list("id")).alias("ids"))
    classes = materialise(classes.select(F.col("ids")[0].alias("id"), "ids", "vector", F.size("vector").alias("width")))
    usual = classes.groupBy("width").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "width").first()
    width, amount = (usual["width"], usual["n"]) if usual else (1, 0)

    size = min(sample_rows, max(1, SAMPLE_BYTES // (4 * width)))
    learned = classes.where(F.col("width") == width).select("id", "vector").orderBy(F.xxhash64("id"), "id").limit(size).select("vector").toArrow()
    sample = matrix(learned.column("vector")) if amount else np.ones((1, 1), dtype=np.float32)
    grown = forest.learn(sample, max(1, amount), neighbours, trees, leaf_rows, wanted)
    indexed = classes.select("id", "vector", "width")
    counts = map_batches(indexed, _counted(grown, width), "leaf long, n long").groupBy("leaf").agg(F.sum("n").alias("n"))
    parts = {leaf: -(-n // BLOCK_ROWS) for leaf, n in counts.collect()}

    placed = map_batches(indexed, _placed(grown, width, parts), "block long, id long, vector " + single.schema["vector"].dataType.simpleString())
    members_asked = single.where("asked").select(F.col("id").alias("query_id"), "vector").join(classes.select("vector", F.col("id").alias("query")), "vector")
    members_asked = materialise(members_asked.select("query_id", "query"))
    asked = indexed.join(members_asked.select(F.col("query").alias("id")).distinct(), "id", "left_semi")
    visiting = map_batches(asked, _visiting(grown, width, parts, wanted), placed.schema)
    found = meet(placed, visiting, _block, _best(neighbours + 1), "query long, id long, score double", _combined(neighbours + 1))

    nearest_first = Window.partitionBy("query").orderBy(F.desc("score"), "id")
    best = found.groupBy("query", "id").agg(F.max("score").alias("score")).withColumn("place", F.row_number().over(nearest_first)).where(F.col("place") <= neighbours + 1)
    spread = best.join(classes.select("id", "ids"), "id").select("query", "score", F.explode("ids").alias("id"))
    spread = materialise(spread.withColumn("place", F.row_number().over(nearest_first)).where(F.col("place") <= neighbours + 1))
    answers = members_asked.join(spread, "query").where("query_id <> id")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "id"))
    return answers.withColumn("rank", rank).where(F.col("rank") <= neighbours).select("query_id", "rank", F.col("id").alias(key), "score")
