"""Near-duplicate documents by improved consistent weighted sampling over TF-IDF shingles.

Shingles are five consecutive words (runs of letters and digits, lower case); a text of fewer words is one shingle.
A shingle weighs its count times ln(1 + 1 / share), its share of documents being counted over all of them in a
count-min sketch and taken as ``RARE`` at least, so that only shingles found in more than that weigh less.  So that a
group of copies and near copies does not make its own shingles weigh less the larger it is, a document counts in the
shares only if none with a smaller key has the same least shingle by either of two hashes (``sketch_shares``): of a
group about one counts, whatever its size.  Signatures
of improved consistent weighted sampling (Ioffe, 2010) are cut into bands; documents that share a band are candidates,
and pairs count as linked from a weighted Jaccard similarity of ``threshold`` on, computed exactly.

The pairs of a bucket are never listed.  First every document is compared with the least one of each of its buckets;
links give components.  Then documents of one bucket that are still in different components are compared, block by
block, by parity sketches of their shingles: they bound the weight of the difference of two documents from below, and
so their similarity from above, and only pairs that may reach the threshold by this bound go on to be verified.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfcast.llm.codepoints import LETTER, NUMBER, classes, decode, mix, span_hashes, words_between
from shelfcast.llm.graph import components
from shelfcast.llm.shared import chunks, map_batches, materialise, ship_code, strings

WORDS, BANDS, ROWS = 5, 14, 4
RARE = 0.01
#: Count-min sketch: two rows of so many cells.
CELLS = 1 << 19
#: Parity sketch: bits of each class of weights, and the least weight of each class of document shares.
BITS = 512
LEAST = (np.log(2), 1.5, 2.4, 3.3, 4.2, np.log1p(1 / RARE))
#: Documents of a bucket that are compared at once with as many.
TILE = 256
_BLOCK = 1 << 14
_CHUNK = 1 << 20
_GAMMA: dict[str, np.ndarray] = {}


def shingles(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct shingles of each text: text number, 64-bit hash, count; ordered by text, then hash."""
    points, starts = decode([text.lower() for text in texts])
    kind = classes()[points]
    begin, end, owner = words_between(points, starts, (kind != LETTER) & (kind != NUMBER))
    words = span_hashes(points, begin, end)
    if not len(words):
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.uint64), np.zeros(0, dtype=np.int64)
    count = np.bincount(owner, minlength=len(texts))
    first = np.cumsum(count) - count
    hashes = np.zeros(len(words), dtype=np.uint64)
    for k in range(WORDS):
        # words behind the text's last one count as nothing, so that short texts have one shingle of all their words
        at = np.arange(len(words)) + k
        inside = (at < len(words)) & (owner[np.minimum(at, len(words) - 1)] == owner)
        hashes = mix(hashes * np.uint64(0x2545F4914F6CDD1D) + np.where(inside, words[np.minimum(at, len(words) - 1)], np.uint64(0)) + np.uint64(k + 1))
    place = np.arange(len(words)) - first[owner]
    kept = (place + WORDS <= count[owner]) | (place == 0) & (count[owner] < WORDS)
    owner, hashes = owner[kept], hashes[kept]
    order = np.lexsort((hashes, owner))
    owner, hashes = owner[order], hashes[order]
    new = np.ones(len(owner), dtype=bool)
    new[1:] = (owner[1:] != owner[:-1]) | (hashes[1:] != hashes[:-1])
    at = np.flatnonzero(new)
    return owner[at], hashes[at], np.diff(np.append(at, len(owner)))


def _cells(hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return (hashes & np.uint64(CELLS - 1)).astype(np.int64), (hashes >> np.uint64(40) & np.uint64(CELLS - 1)).astype(np.int64) + CELLS


def _weights(hashes: np.ndarray, counts: np.ndarray, sketch: np.ndarray) -> np.ndarray:
    """TF-IDF weights; the sketch holds shares of documents."""
    one, two = _cells(hashes)
    share = np.clip(np.minimum(sketch[one], sketch[two]), RARE, 1)
    return counts * np.log1p(1 / share)


def _tables() -> tuple[np.ndarray, np.ndarray]:
    """Quantiles of the Gamma(2, 1) distribution at 2**16 points, and their reciprocals."""
    if not _GAMMA:
        chance = (np.arange(1 << 16) + 0.5) / (1 << 16)
        value = np.full(1 << 16, 1.7)
        for _ in range(60):  # Newton's method on 1 - (1 + x) exp(-x) = chance, kept positive
            value = np.maximum(value - (1 - (1 + value) * np.exp(-value) - chance) / (value * np.exp(-value) + 1e-300), value / 4)
        _GAMMA["value"], _GAMMA["reciprocal"] = value.astype(np.float32), (1 / value).astype(np.float32)
    return _GAMMA["value"], _GAMMA["reciprocal"]


def signatures(owner: np.ndarray, hashes: np.ndarray, weights: np.ndarray, texts: int) -> np.ndarray:
    """BANDS * ROWS samples of each text that has a shingle, as 64-bit values; rows of zeros for the others."""
    out = np.zeros((texts, BANDS * ROWS), dtype=np.uint64)
    if not len(owner):
        return out
    gamma, reciprocal = _tables()
    present, begin = np.unique(owner, return_index=True)
    length = np.diff(np.append(begin, len(owner)))
    log_weight = np.log(weights).astype(np.float32)
    for k in range(BANDS * ROWS):
        bits = mix(hashes + np.uint64((k + 1) * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF))
        place = (bits & np.uint64(0xFFFF)).astype(np.int64)
        r = gamma[place]
        beta = ((bits * np.uint64(0xD1342543DE82EF95)) >> np.uint64(40)).astype(np.float32) * np.float32(2**-24)
        u = ((bits >> np.uint64(16)) & np.uint64(0xFFFFFF)).astype(np.float32) + np.float32(0.5)
        v = (bits >> np.uint64(40)).astype(np.float32) + np.float32(0.5)
        c = np.float32(48 * np.log(2)) - np.log(u) - np.log(v)
        t = np.floor(log_weight * reciprocal[place] + beta)
        log_a = np.log(c) - r * (t - beta) - r
        least = np.minimum.reduceat(log_a, begin)
        at = np.flatnonzero(log_a == np.repeat(least, length))
        own = np.searchsorted(begin, at, side="right") - 1
        first = np.concatenate(([True], own[1:] != own[:-1]))
        at = at[first]
        out[present, k] = mix(hashes[at] + t[at].astype(np.int64).astype(np.uint64) * np.uint64(0xA24BAED4963EE407))
    return out


def sketches(owner: np.ndarray, hashes: np.ndarray, counts: np.ndarray, weights: np.ndarray, texts: int) -> np.ndarray:
    """Parity of the shingles of each text and class of weights on each bit; a shingle found n times counts as n elements."""
    each = np.repeat(np.arange(len(hashes)), counts)
    rank = np.arange(len(each)) - np.repeat(np.cumsum(counts) - counts, counts)
    group = np.maximum(np.searchsorted(np.array(LEAST) + 1e-9, weights / np.maximum(counts, 1) + 2e-6, side="right") - 1, 0)
    bit = (mix(hashes[each] + rank.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) & np.uint64(BITS - 1)).astype(np.int64)
    cell = (owner[each] * len(LEAST) + group[each]) * BITS + bit
    odd = (np.bincount(cell, minlength=texts * len(LEAST) * BITS) & 1).astype(np.uint8)
    return np.packbits(odd).reshape(texts, -1)


def may_link(left: tuple[np.ndarray, np.ndarray], right: tuple[np.ndarray, np.ndarray], threshold: float) -> np.ndarray:
    """Which pairs of two lists of (sketch, sum of weights) may reach the threshold."""
    apart = np.zeros((len(left[1]), len(right[1])))
    words = BITS // 64
    one, two = left[0].view(np.uint64), right[0].view(np.uint64)
    for group, least in enumerate(LEAST):
        for word in range(group * words, (group + 1) * words):
            apart += (least - 1e-5) * np.bitwise_count(one[:, word, None] ^ two[None, :, word])
    whole = left[1][:, None] + right[1][None, :]
    shared = np.minimum((whole - apart) / 2, np.minimum(left[1][:, None], right[1][None, :]))
    return shared >= (threshold - 1e-6) * (whole - shared)


def jaccard(left: tuple[np.ndarray, np.ndarray], right: tuple[np.ndarray, np.ndarray]) -> float:
    """Weighted Jaccard similarity of two (ascending hashes, weights)."""
    _, a, b = np.intersect1d(left[0], right[0], assume_unique=True, return_indices=True)
    shared = np.minimum(left[1][a], right[1][b]).sum()
    whole = left[1].sum() + right[1].sum() - shared
    return float(shared / whole) if whole > 0 else 0.0


def _count_documents(texts: DataFrame) -> np.ndarray:
    """How many documents hold a shingle of each cell of the sketch; a column ``times`` says as how many a row counts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = np.zeros(2 * CELLS, dtype=np.int64)
        for batch in chunks(batches, "text", _CHUNK):
            owner, hashes, _ = shingles(strings(batch, "text"))
            times = batch.column("times").to_numpy()[owner] if "times" in batch.schema.names else None
            for cell in _cells(hashes):
                found += np.bincount(cell, weights=times, minlength=2 * CELLS).astype(np.int64)
        blocks = found.reshape(-1, _BLOCK)
        some = np.flatnonzero(blocks.any(axis=1))
        packed = [zstandard.compress(blocks[row].tobytes(), 1) for row in some]
        yield pa.record_batch([pa.array(some.astype(np.int32)), pa.array(packed, pa.binary())], ["block", "counts"])

    def add(rows: pd.DataFrame) -> pd.DataFrame:
        total = np.zeros(_BLOCK, dtype=np.int64)
        for packed in rows["counts"]:
            total += np.frombuffer(zstandard.decompress(packed), dtype=np.int64)
        return pd.DataFrame({"block": [rows["block"].iloc[0]], "counts": [zstandard.compress(total.tobytes(), 1)]})

    some = map_batches(texts, run, "block int, counts binary")
    # two rounds, so that no task gets more than a share of what all tasks send
    fewer = some.withColumn("salt", F.pmod(F.spark_partition_id(), F.lit(32))).groupBy("block", "salt").applyInPandas(add, "block int, counts binary")
    out = np.zeros((2 * CELLS // _BLOCK, _BLOCK), dtype=np.int64)
    for row in fewer.groupBy("block").applyInPandas(add, "block int, counts binary").collect():
        out[row["block"]] = np.frombuffer(zstandard.decompress(row["counts"]), dtype=np.int64)
    return out.reshape(-1)


def _looks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of each document with a shingle: the least of its shingles by two hashes."""
    for batch in chunks(batches, "text", _CHUNK):
        owner, hashes, _ = shingles(strings(batch, "text"))
        has, begin = np.unique(owner, return_index=True)
        rows = batch.select(["id", "digest"]).take(pa.array(has))
        least = [np.minimum.reduceat(mix(hashes ^ np.uint64(seed)), begin).view(np.int64) if len(has) else np.zeros(0, dtype=np.int64) for seed in (0x5851F42D4C957F2D, 0x14057B7EF767814F)]
        yield pa.record_batch([*rows.columns, *(pa.array(values) for values in least)], ["id", "digest", "one", "two"])


def _likely(rows: DataFrame, wanted: DataFrame) -> DataFrame:
    """The rows whose id may be wanted: a set of 2**21 hash values at most lets only these reach an exchange."""
    cell = F.pmod(F.xxhash64("id"), F.lit(1 << 21))
    return rows.withColumn("cell", cell).join(F.broadcast(wanted.select(cell.alias("cell")).distinct()), "cell", "left_semi").drop("cell")


def sketch_shares(rows: DataFrame) -> np.ndarray:
    """Shares by cell of the documents (id, digest, text) that are the least of both their looks.

    All documents are counted; those that are not the least of a look, and repeated rows, are then taken off again, so
    that only their texts move.
    """
    looks = materialise(map_batches(rows.where("id is not null").select("id", "digest", "text"), _looks, "id long, digest binary, one long, two long"))
    each = looks.groupBy("id", "digest", "one", "two").agg(F.count("*").alias("n"))
    own = F.struct("id", "digest")
    leaders = [looks.groupBy(name).agg(F.min(own).alias(f"least_{name}")) for name in ("one", "two")]
    judged = materialise(each.join(leaders[0], "one").join(leaders[1], "two").withColumn("counted", ((F.col("least_one") == own) & (F.col("least_two") == own)).cast("long")))
    off = materialise(judged.select("id", "digest", (F.col("n") - F.col("counted")).alias("times")).where("times > 0"))
    counts = _count_documents(rows.where("id is not null").select("text"))
    texts = _likely(rows, off).join(off, ["id", "digest"]).dropDuplicates(["id", "digest"]).select("text", "times")
    total = judged.agg(F.sum("counted")).first()[0] or 0
    return (counts - _count_documents(texts)) / max(total, 1)


def _near(rows: DataFrame, pairs: DataFrame, sketch, threshold: float) -> DataFrame:
    """Those of the pairs (a, b) of ids whose similarity reaches the threshold."""
    wanted = pairs.select(F.col("a").alias("id")).unionByName(pairs.select(F.col("b").alias("id"))).distinct()
    texts = materialise(_likely(rows, wanted).join(wanted, "id", "left_semi").select("id", "text"))
    both = pairs.join(texts.select(F.col("id").alias("a"), F.col("text").alias("left")), "a").join(texts.select(F.col("id").alias("b"), F.col("text").alias("right")), "b")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shares = sketch.value
        for batch in chunks(batches, "left", _CHUNK):
            sides = []
            for side in ("left", "right"):
                texts_ = strings(batch, side)
                owner, hashes, counts = shingles(texts_)
                weight = _weights(hashes, counts, shares)
                bounds = np.searchsorted(owner, np.arange(len(texts_) + 1))
                sides.append([(hashes[x:y], weight[x:y]) for x, y in zip(bounds[:-1], bounds[1:], strict=True)])
            linked = [jaccard(x, y) >= threshold - 1e-12 for x, y in zip(*sides, strict=True)]
            yield batch.select(["a", "b"]).filter(pa.array(linked, pa.bool_()))

    return materialise(map_batches(both, run, "a long, b long"))


def _possible_pairs(threshold: float):
    """Pairs of ids of two blocks of documents in different components that may be linked."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                sides = []
                for name in ("x", "y"):
                    own = batch.column(name)[row].values
                    sketch = np.frombuffer(b"".join(own.field("sketch").to_pylist()), dtype=np.uint8).reshape(len(own), -1)
                    sides.append((own.field("id").to_numpy(), own.field("component").to_numpy(), sketch, own.field("weight").to_numpy(), own.field("bands").flatten().to_numpy().reshape(len(own), -1)))
                x, y = sides
                fits = may_link((x[2], x[3]), (y[2], y[3]), threshold) & (x[1][:, None] != y[1][None, :])
                a, b = np.nonzero(fits)
                # of the buckets that two documents share, only the first gives the pair
                first = (x[4][a] == y[4][b]).argmax(axis=1) == batch.column("band")[row].as_py()
                a, b = x[0][a[first]], y[0][b[first]]
                yield pa.record_batch([pa.array(np.minimum(a, b)), pa.array(np.maximum(a, b))], ["a", "b"])

    return run


def near_duplicates(documents: DataFrame, threshold: float = 0.8, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, class_id, class_size, kept) of every row: near copies share a class, whose least key is its id and is kept.

    Equal texts are one node, so a chain of links between different texts joins all their copies.  Texts without a word
    and rows without a key are alone in their class and kept.  Rows that repeat a key and a text are one document.
    An empty table gives an empty result; other columns are not read.
    """
    spark = documents.sparkSession
    ship_code(spark)
    rows = documents.select(F.col(key).cast("long").alias("id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    rows = rows.withColumn("digest", F.unhex(F.md5(F.col("text").cast("binary"))))
    ids = materialise(rows.select("id", "digest", F.col("text").rlike(r"[\p{L}\p{N}]").alias("some")))
    usable = F.col("some") & F.col("id").isNotNull()
    classes_ = materialise(ids.where(usable).groupBy("digest").agg(F.min("id").alias("least"), F.count("*").alias("copies")))
    sketch = spark.sparkContext.broadcast(sketch_shares(rows).astype(np.float32))  # CELLS * 8 bytes, always

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shares = sketch.value
        for batch in chunks(batches, "text", _CHUNK):
            texts = strings(batch, "text")
            owner, hashes, counts = shingles(texts)
            weights = _weights(hashes, counts, shares)
            samples = signatures(owner, hashes, weights, len(texts))
            bands = np.zeros((len(texts), BANDS), dtype=np.uint64)
            for row in range(ROWS):
                bands = mix(bands * np.uint64(0x2545F4914F6CDD1D) + samples[:, row::ROWS])
            has = np.isin(np.arange(len(texts)), owner)
            mask = pa.array(has)
            listed = pa.FixedSizeListArray.from_arrays(pa.array(bands.view(np.int64).ravel()), BANDS).filter(mask).cast(pa.list_(pa.int64()))
            packed = pa.array([row.tobytes() for row in sketches(owner, hashes, counts, weights, len(texts))[has]], pa.binary())
            total = pa.array(np.bincount(owner, weights=weights, minlength=len(texts))[has])
            yield pa.record_batch([batch.column("id").filter(mask), batch.column("digest").filter(mask), listed, packed, total], ["id", "digest", "bands", "sketch", "weight"])

    signed = map_batches(rows, sign, "id long, digest binary, bands array<long>, sketch binary, weight double")
    leaders = classes_.select(F.col("least").alias("id"), "digest")
    signed = materialise(signed.join(leaders, ["id", "digest"], "left_semi").dropDuplicates(["id", "digest"]))
    buckets = signed.select("id", F.posexplode("bands").alias("band", "bucket"))
    shared = buckets.groupBy("band", "bucket").agg(F.min("id").alias("a"), F.count("*").alias("n")).where("n > 1").drop("n")
    stars = materialise(buckets.join(shared, ["band", "bucket"]).where("id <> a").select("a", F.col("id").alias("b")).distinct())
    links = _near(rows, stars, sketch, threshold)
    first = materialise(components(links))

    own = buckets.join(first.withColumnRenamed("node", "id"), "id", "left").withColumn("component", F.coalesce("component", "id"))
    mixed = own.groupBy("band", "bucket").agg(F.min("component").alias("x"), F.max("component").alias("y"), F.count("*").alias("n")).where("x <> y").select("band", "bucket", "n")
    blocks = F.ceil(F.col("n") / TILE).cast("int")
    mixed = mixed.withColumn("blocks", blocks).drop("n")
    apart = own.join(mixed, ["band", "bucket"]).join(signed.select("id", "bands", "sketch", "weight"), "id").withColumn("block", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int"))
    packed = apart.groupBy("band", "bucket", "block").agg(F.collect_list(F.struct("id", "component", "bands", "sketch", "weight")).alias("own"))
    both = packed.select("band", "bucket", F.col("block").alias("i"), F.col("own").alias("x")).join(packed.select("band", "bucket", F.col("block").alias("j"), F.col("own").alias("y")), ["band", "bucket"])
    ordered = map_batches(both.where("i <= j").select("band", "x", "y"), _possible_pairs(threshold), "a long, b long").distinct()
    second = _near(rows, materialise(ordered.join(stars, ["a", "b"], "left_anti")), sketch, threshold)
    grouped = components(links.unionByName(second))
    named = classes_.join(grouped.withColumnRenamed("node", "least"), "least", "left").select("digest", F.coalesce("component", "least").alias("class_id"), "copies")
    sizes = named.groupBy("class_id").agg(F.sum("copies").alias("class_size"))
    known = named.drop("copies").join(sizes, "class_id")
    out = ids.where(usable).join(known, "digest").select("id", "class_id", "class_size")
    alone = ids.where(~F.coalesce(usable, F.lit(False))).select("id", F.col("id").alias("class_id"), F.lit(1).cast("long").alias("class_size"))
    return out.unionByName(alone).select(F.col("id").alias(key), "class_id", "class_size", F.coalesce(F.col("id") == F.col("class_id"), F.lit(True)).alias("kept"))
