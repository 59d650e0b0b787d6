"""Near-duplicate vectors by int8 tile products with rigorous error bounds.

Equal vectors of a label become one representative with a weight.  Representatives are dealt into tiles; every pair of
tiles of a label meets once and is multiplied as int8 values (exactly, in single-precision products of bounded
length).  With u = q + e the cosine differs from that of the quantised vectors by at most
|q1||e2| + |e1||q2| + |e1||e2|; pairs certainly linked are counted where they are found and leave only a spanning
forest, pairs that the bound cannot decide are recomputed in double precision from the full vectors.  The pairs of a
group are never listed.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfcast.llm.graph import components
from shelfcast.llm.shared import map_batches, materialise, ship_code

#: Vectors in a tile: at least, at most, and tiles that a label is dealt into before tiles grow.
TILE_ROWS, MOST_ROWS, TILES = 4096, 65536, 256
_BLOCK = 1024
_SLACK = 1e-9


def _tile(table: pa.Table) -> pa.Table:
    """The vectors of one tile as one row of packed columns: ids, weights, int8 values, scales, lengths, errors."""
    ids = table.column("id").to_numpy()
    order = np.argsort(ids, kind="stable")
    vectors = table.column("vector").combine_chunks().flatten().to_numpy().astype(np.float64).reshape(len(ids), -1)[order]
    unit = vectors / np.sqrt((vectors / np.abs(vectors).max(axis=1, keepdims=True)).__pow__(2).sum(axis=1, keepdims=True)) / np.abs(vectors).max(axis=1, keepdims=True)
    scale = np.abs(unit).max(axis=1) / 127
    values = np.rint(unit / scale[:, None])
    near = values * scale[:, None]
    out = {
        "ids": ids[order].astype(np.int64), "weights": table.column("weight").to_numpy()[order].astype(np.int64), "values": values.astype(np.int8),
        "scale": scale, "size": np.linalg.norm(near, axis=1), "error": np.linalg.norm(unit - near, axis=1),
    }
    columns = {name: table.column(name).slice(0, 1) for name in ("label", "width", "tile", "tiles")}
    return pa.table(columns | {name: pa.array([array.tobytes()], pa.binary()) for name, array in out.items()})


_TILE_SCHEMA = "label int, width int, tile int, tiles int, ids binary, weights binary, values binary, scale binary, size binary, error binary"


def _unpack(row: dict, width: int) -> dict[str, np.ndarray]:
    kinds = {"ids": np.int64, "weights": np.int64, "values": np.int8, "scale": np.float64, "size": np.float64, "error": np.float64}
    out = {name: np.frombuffer(row[name], dtype=kind) for name, kind in kinds.items()}
    out["values"] = out["values"].reshape(-1, width).astype(np.float32)
    return out


class _Forest:
    """Union-find over the rows of two tiles; ``joined`` lists only the links that joined two trees."""

    def __init__(self, count: int):
        self.parent = np.arange(count)
        self.joined: list[tuple[int, int]] = []

    def root(self, node: int) -> int:
        while self.parent[node] != node:
            self.parent[node] = node = self.parent[self.parent[node]]
        return node

    def add(self, left: np.ndarray, right: np.ndarray) -> None:
        pending = np.ones(len(left), dtype=bool)
        while True:
            flat = self.parent
            while not np.array_equal(flat, flat[flat]):
                flat = flat[flat]
            self.parent = flat
            pending &= flat[left] != flat[right]
            rows = np.flatnonzero(pending)
            if not len(rows):
                return
            _, first = np.unique(np.maximum(flat[left[rows]], flat[right[rows]]), return_index=True)
            for row in rows[first]:
                a, b = self.root(int(left[row])), self.root(int(right[row]))
                if a != b:
                    self.parent[max(a, b)] = min(a, b)
                    self.joined.append((int(left[row]), int(right[row])))


def _products(threshold: float):
    """Rows (id, links, other, kind): counts of sure links by vector, forest edges, and pairs left undecided."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for pair in batch.to_pylist():
                width = pair["width"]
                same = pair["left"]["tile"] == pair["right"]["tile"]
                x, y = _unpack(pair["left"], width), _unpack(pair["right"], width)
                n, m = len(x["ids"]), len(y["ids"])
                links = np.zeros(n, dtype=np.int64), np.zeros(m, dtype=np.int64)
                forest = _Forest(n + (0 if same else m))
                unsure: list[tuple[np.ndarray, np.ndarray]] = []
                for i in range(0, n, _BLOCK):
                    a = slice(i, min(n, i + _BLOCK))
                    for j in range(i if same else 0, m, _BLOCK):
                        b = slice(j, min(m, j + _BLOCK))
                        product = np.zeros((a.stop - a.start, b.stop - b.start))
                        for k in range(0, width, 1024):  # up to 1024 products of int8 values are exact in float32
                            product += x["values"][a, k : k + 1024] @ y["values"][b, k : k + 1024].T
                        product *= x["scale"][a, None] * y["scale"][None, b]
                        bound = x["size"][a, None] * y["error"][None, b] + x["error"][a, None] * (y["size"] + y["error"])[None, b] + _SLACK
                        near = product + bound >= threshold
                        if same and i == j:
                            near = np.triu(near, 1)
                        rows, columns = np.nonzero(near)
                        sure = product[rows, columns] - bound[rows, columns] >= threshold
                        r, c = rows[sure] + i, columns[sure] + j
                        np.add.at(links[0], r, y["weights"][c])
                        np.add.at(links[0] if same else links[1], c, x["weights"][r])
                        forest.add(r, c + (0 if same else n))
                        if not sure.all():
                            unsure.append((x["ids"][rows[~sure] + i], y["ids"][columns[~sure] + j]))
                ids = x["ids"] if same else np.concatenate((x["ids"], y["ids"]))
                counts = links[0] if same else np.concatenate(links)
                some = counts > 0
                edges = np.array(forest.joined, dtype=np.int64).reshape(-1, 2)
                pairs = [np.concatenate([p[side] for p in unsure]) if unsure else np.zeros(0, dtype=np.int64) for side in (0, 1)]
                first = np.concatenate((ids[some], ids[edges[:, 0]], pairs[0]))
                other = np.concatenate((ids[some], ids[edges[:, 1]], pairs[1]))
                amount = np.concatenate((counts[some], np.zeros(len(edges) + len(pairs[0]), dtype=np.int64)))
                kind = np.repeat(np.array([0, 1, 2], dtype=np.int32), [some.sum(), len(edges), len(pairs[0])])
                yield pa.record_batch([pa.array(first), pa.array(other), pa.array(amount), pa.array(kind)], ["a", "b", "links", "kind"])

    return run


def near_vectors(vectors: DataFrame, threshold: float = 0.93, key: str = "vec_id", vector: str = "embedding", label: str = "label") -> DataFrame:
    """(key, n_links, component_id, kept) of every row: other rows of its label with a cosine of at least ``threshold``.

    A row whose key, label or vector is null, or whose vector is empty, zero or holds a null or non-finite number,
    links with nothing.  Vectors of different lengths never link.  Equal rows link with each other; rows that repeat a
    key share its component.  An empty table gives an empty result; other columns are not read.
    """
    ship_code(vectors.sparkSession)
    rows = vectors.select(F.col(key).cast("long").alias("id"), F.col(vector).cast("array<float>").alias("vector"), F.col(label).cast("int").alias("label"))
    fits = F.col("id").isNotNull() & F.col("label").isNotNull() & (F.size("vector") > 0)
    finite = F.forall("vector", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf"))) & F.exists("vector", lambda v: v != 0)
    valid = rows.where(fits & finite)
    classes = materialise(valid.groupBy("label", "vector").agg(F.min("id").alias("id"), F.count("*").alias("weight")))
    sized = classes.withColumn("width", F.size("vector"))
    amounts = sized.groupBy("label", "width").agg(F.count("*").alias("n"))
    per_tile = F.least(F.lit(MOST_ROWS), F.greatest(F.lit(TILE_ROWS), F.ceil(F.col("n") / TILES)))
    amounts = amounts.withColumn("tiles", F.ceil(F.col("n") / per_tile).cast("int"))
    dealt = sized.join(amounts.drop("n"), ["label", "width"]).withColumn("tile", F.pmod(F.xxhash64("id"), F.col("tiles")).cast("int"))
    tiles = materialise(dealt.groupBy("label", "width", "tile").applyInArrow(_tile, _TILE_SCHEMA))
    packed = F.struct("tile", "ids", "weights", "values", "scale", "size", "error")
    other = F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)).alias("other")
    copies = tiles.select("label", "width", "tile", packed.alias("side"), other)
    left = copies.where("tile <= other").select("label", "width", F.col("tile").alias("i"), F.col("other").alias("j"), F.col("side").alias("left"))
    right = copies.where("tile >= other").select("label", "width", F.col("other").alias("i"), F.col("tile").alias("j"), F.col("side").alias("right"))
    pairs = left.join(right.hint("shuffle_merge"), ["label", "width", "i", "j"]).select("width", "left", "right")
    found = materialise(map_batches(pairs, _products(threshold), "a long, b long, links long, kind int"))

    whole = classes.select("id", "vector", "weight")
    unsure = found.where("kind = 2").select("a", "b")
    unsure = unsure.join(whole.select(F.col("id").alias("a"), F.col("vector").alias("va"), F.col("weight").alias("wa")), "a")
    unsure = unsure.join(whole.select(F.col("id").alias("b"), F.col("vector").alias("vb"), F.col("weight").alias("wb")), "b")

    def dot(x: str, y: str) -> F.Column:
        return F.aggregate(F.zip_with(x, y, lambda p, q: p.cast("double") * q.cast("double")), F.lit(0.0), lambda total, value: total + value)

    proven = materialise(unsure.where(dot("va", "vb") / F.sqrt(dot("va", "va")) / F.sqrt(dot("vb", "vb")) >= threshold).select("a", "b", "wa", "wb"))
    counts = (
        found.where("kind = 0").select(F.col("a").alias("id"), "links")
        .unionByName(proven.select(F.col("a").alias("id"), F.col("wb").alias("links")))
        .unionByName(proven.select(F.col("b").alias("id"), F.col("wa").alias("links")))
        .groupBy("id").agg(F.sum("links").alias("links"))
    )
    grouped = components(found.where("kind = 1").select("a", "b").unionByName(proven.select("a", "b")))
    known = (
        classes.join(counts, "id", "left").join(grouped.withColumnRenamed("node", "id"), "id", "left")
        .select("label", "vector", (F.coalesce("links", F.lit(0)) + F.col("weight") - 1).alias("n_links"), F.coalesce("component", "id").alias("component_id"))
    )
    linked = valid.join(known, ["label", "vector"]).select("id", "n_links", "component_id")
    alone = rows.where(~F.coalesce(fits & finite, F.lit(False))).select("id", F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id"))
    out = linked.unionByName(alone)
    return out.select(F.col("id").alias(key), "n_links", "component_id", F.coalesce(F.col("id") == F.col("component_id"), F.lit(True)).alias("kept"))


def oracle_sql(threshold: float = 0.93) -> str:
    """The query's rows in DuckDB: all pairs of a label, and all that can be reached from each vector."""
    return f"""
WITH RECURSIVE usable AS (
  SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS v FROM embeddings WHERE vec_id IS NOT NULL AND label IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0
), links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM usable AS a JOIN usable AS b ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.v) = len(b.v)
    AND list_dot_product(a.v, b.v) / sqrt(list_dot_product(a.v, a.v)) / sqrt(list_dot_product(b.v, b.v)) >= {threshold}
), reach AS (
  SELECT DISTINCT a AS v, a AS o FROM links UNION SELECT r.v, l.b FROM reach AS r JOIN links AS l ON l.a = r.o
), least AS (SELECT v, min(o) AS component_id FROM reach GROUP BY v), counts AS (SELECT a, count(*) AS n_links FROM links GROUP BY a)
SELECT vec_id, coalesce(n_links, 0) AS n_links, coalesce(component_id, vec_id) AS component_id, coalesce(vec_id = coalesce(component_id, vec_id), true) AS kept
FROM embeddings LEFT JOIN least ON v = vec_id LEFT JOIN counts ON a = vec_id
"""
