"""Packing of documents into training sequences by lexical retrieval.

Documents are tokenised, their document frequencies counted over all documents, and dealt to shards by their most
telling token, so that documents on one matter meet; shards hold about ``SHARD_TOKENS``, and a token that marks more
documents than that gets several.  Each shard is a BM25 inverted index of its own.  A seed document starts a window;
the index returns its unused neighbours, best first, which fill the window.  The neighbour that does not fit is cut,
and its rest is the seed of the next window, so only the last window of a shard is padded.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfcast.llm import bpe
from shelfcast.llm.codepoints import decode, distinct_spans
from shelfcast.llm.shared import chunks, map_batches, materialise, ship_code, strings

WINDOW, END = 2048, 1
SHARD_TOKENS = 400_000
K1, B = 1.2, 0.75
_CHUNK, _WORDS = 2 << 20, 400_000


def normal(text: str) -> str:
    """The vocabulary's normal form: composed, lower case letter by letter (no final sigma); blanks only part words."""
    if not text.isascii():
        text = unicodedata.normalize("NFC", text).replace("Σ", "σ")
    return text.lower()


class Encoder:
    """Encodes texts by a word-end vocabulary; the words of a task are merged once (the memory of them is bounded)."""

    def __init__(self, path: str):
        self.merges = bpe.word_file(path)
        self._forget()

    def _forget(self) -> None:
        self.known: dict[str, int] = {}
        self.ids = np.zeros(0, dtype=np.uint16)
        self.bounds = np.zeros(1, dtype=np.int64)

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts in one array, and how many each text has."""
        if len(self.known) > _WORDS:
            self._forget()
        texts = [normal(text) for text in texts]
        points, starts = decode(texts)
        begin, end = bpe.split_words(points, starts)
        codes, first = distinct_spans(points, begin, end)
        every = "".join(texts)
        words = [every[a:b] for a, b in zip(begin[first].tolist(), end[first].tolist(), strict=True)]
        place = np.fromiter((self.known.get(word, -1) for word in words), dtype=np.int64, count=len(words))
        fresh = np.flatnonzero(place < 0)
        if len(fresh):
            unknown = [words[row] for row in fresh.tolist()]
            ids, counts = self.merges.encode([word.encode() for word in unknown])
            place[fresh] = np.arange(len(self.known), len(self.known) + len(fresh))
            self.known.update(zip(unknown, place[fresh].tolist(), strict=True))
            self.ids = np.concatenate((self.ids, ids.astype(np.uint16)))
            self.bounds = np.concatenate((self.bounds, self.bounds[-1] + np.cumsum(counts)))
        own = place[codes]
        size = self.bounds[own + 1] - self.bounds[own]
        total = np.concatenate(([0], np.cumsum(size)))
        ids = self.ids[np.repeat(self.bounds[own] - total[:-1], size) + np.arange(total[-1])]
        return ids, np.diff(total[np.searchsorted(begin, starts)])


def _pack(ids: np.ndarray) -> bytes:
    return zstandard.compress(ids.tobytes(), 1)


def _unpack(packed: bytes) -> np.ndarray:
    return np.frombuffer(zstandard.decompress(packed), dtype=np.uint16)


def _counted(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct tokens of a document in order, and how often each comes."""
    ordered = np.sort(ids, kind="stable")
    begin = np.flatnonzero(np.concatenate((ordered[:1] == ordered[:1], ordered[1:] != ordered[:-1])))
    return ordered[begin].astype(np.int64), np.diff(np.append(begin, len(ordered)))


def tokenise(documents: DataFrame, path: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, tokens, salt, ids): the ids of each text with the end id behind them, packed as 16-bit numbers."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, row = Encoder(path), TaskContext.get().partitionId() * 7919
        for batch in chunks(batches, "text", _CHUNK):
            ids, counts = encoder.encode(strings(batch, "text"))
            ends = np.concatenate(([0], np.cumsum(counts)))
            packed = [_pack(np.append(ids[a:b], np.uint16(END))) for a, b in zip(ends[:-1], ends[1:], strict=True)]
            salt = np.arange(row, row + len(packed), dtype=np.int32)
            row += len(packed)
            yield pa.record_batch([batch.column("key"), pa.array(counts + 1), pa.array(salt), pa.array(packed, pa.binary())], ["key", "tokens", "salt", "ids"])

    return map_batches(documents.select(F.col(key).cast("long").alias("key"), F.col(text).alias("text")), run, "key long, tokens long, salt int, ids binary")


def _frequencies(tokenised: DataFrame) -> np.ndarray:
    """In how many documents each token is found; the vocabulary bounds what the driver gets."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = np.zeros(1 << 16, dtype=np.int64)
        for batch in batches:
            for packed in batch.column("ids").to_pylist():
                found[_counted(_unpack(packed))[0]] += 1
        tokens = np.flatnonzero(found)
        yield pa.record_batch([pa.array(tokens.astype(np.int32)), pa.array(found[tokens])], ["token", "documents"])

    rows = map_batches(tokenised.select("ids"), run, "token int, documents long").groupBy("token").agg(F.sum("documents").alias("documents")).collect()
    out = np.zeros(1 << 16, dtype=np.int64)
    for row in rows:
        out[row["token"]] = row["documents"]
    return out


def _weights(frequency: np.ndarray, documents: int) -> np.ndarray:
    """Inverse document frequencies; nothing for tokens of more than half of the documents."""
    rarity = np.log((documents - frequency + 0.5) / (frequency + 0.5))
    return np.where(frequency > 0, np.maximum(rarity, 0), 0)


def _terms(ids: np.ndarray, rarity: np.ndarray, mean: float) -> tuple[np.ndarray, np.ndarray]:
    """The tokens of a document that weigh anything, and their BM25 weights."""
    tokens, often = _counted(ids)
    some = rarity[tokens] > 0
    tokens, often = tokens[some], often[some]
    return tokens, rarity[tokens] * often * (K1 + 1) / (often + K1 * (1 - B + B * len(ids) / mean))


def _route(tokenised: DataFrame, rarity: np.ndarray, mean: float) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            marks = []
            for packed in batch.column("ids").to_pylist():
                tokens, weight = _terms(_unpack(packed), rarity, mean)
                marks.append(int(tokens[weight.argmax()]) if len(tokens) else -1)
            yield pa.record_batch([*batch.columns, pa.array(marks, pa.int32())], [*batch.schema.names, "mark"])

    return map_batches(tokenised, run, "key long, tokens long, salt int, ids binary, mark int")


class Index:
    """The inverted index of one shard."""

    def __init__(self, documents: list[np.ndarray], rarity: np.ndarray, mean: float):
        terms = [_terms(ids, rarity, mean) for ids in documents]
        self.tokens = [tokens for tokens, _ in terms]
        owner = np.repeat(np.arange(len(terms)), [len(tokens) for tokens, _ in terms])
        every = np.concatenate([tokens for tokens, _ in terms] or [np.zeros(0, dtype=np.int64)])
        order = np.argsort(every, kind="stable")
        self.owner = owner[order]
        self.weight = np.concatenate([weight for _, weight in terms] or [np.zeros(0)])[order]
        self.begin = np.searchsorted(every[order], np.arange((1 << 16) + 1))
        self.count = len(terms)

    def neighbours(self, seed: int, unused: np.ndarray) -> np.ndarray:
        """Unused documents, best first; ties and documents without a common token in their order."""
        tokens = self.tokens[seed]
        begin, size = self.begin[tokens], self.begin[tokens + 1] - self.begin[tokens]
        at = np.repeat(begin - (np.cumsum(size) - size), size) + np.arange(size.sum())
        scores = np.bincount(self.owner[at], weights=self.weight[at], minlength=self.count)
        rest = np.flatnonzero(unused)
        return rest[np.argsort(-scores[rest], kind="stable")]


def fill_windows(documents: list[np.ndarray], rarity: np.ndarray, mean: float, window: int = WINDOW) -> Iterator[tuple[int, int, int, int, int]]:
    """Pieces (document, start, length, window, offset) of one shard."""
    index = Index(documents, rarity, mean)
    unused = np.ones(len(documents), dtype=bool)
    number, space = 0, window
    own, start, following = -1, 0, 0
    while True:
        if own < 0:  # the last window ended with a document: the next unused one is the seed
            while following < len(documents) and not unused[following]:
                following += 1
            if following == len(documents):
                return
            own, start = following, 0
            unused[own] = False
        seed, ranked = own, None
        while True:
            part = min(space, len(documents[own]) - start)
            yield own, start, part, number, window - space
            start, space = start + part, space - part
            if not space:
                number, space = number + 1, window
                own = own if start < len(documents[own]) else -1
                break
            if ranked is None:
                ranked = iter(index.neighbours(seed, unused).tolist())
            own, start = next(ranked, -1), 0
            if own < 0:
                return
            unused[own] = False


def pack(documents: DataFrame, path: str, window: int = WINDOW, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row a piece: key, start, length, ids (little-endian unsigned 32-bit), doc_tokens, sequence_id, offset.

    ``path`` is a tokenizers file whose words end in a suffix, with at most 65,536 ids.  A null or empty text is the
    end id alone.  Every id of every row, repeated rows included, lies in exactly one piece.  An empty table gives none.
    """
    spark = documents.sparkSession
    ship_code(spark)
    tokenised = materialise(tokenise(documents, path, key, text))
    total = tokenised.agg(F.count("*").alias("documents"), F.coalesce(F.sum("tokens"), F.lit(0)).alias("tokens")).first()
    mean = max(total["tokens"] / max(total["documents"], 1), 1.0)
    rarity = _weights(_frequencies(tokenised), total["documents"])
    routed = _route(tokenised, rarity, mean)
    # shards of whole marks in order, several for a mark that is too large for one (the vocabulary bounds the marks)
    marks = routed.groupBy("mark").agg(F.sum("tokens").alias("tokens")).orderBy("mark").collect()
    table, shard, held = [], 0, 0
    for row in marks:
        need = -(-row["tokens"] // SHARD_TOKENS)
        if held and held + row["tokens"] > SHARD_TOKENS:
            shard, held = shard + 1, 0
        table.append((row["mark"], shard, need))
        if need > 1:
            shard, held = shard + need, 0
        else:
            held += row["tokens"]
    places = spark.createDataFrame(table, "mark int, first long, parts long")
    dealt = routed.join(F.broadcast(places), "mark").select("key", "salt", "ids", (F.col("first") + F.pmod(F.col("salt"), F.col("parts"))).alias("shard"))

    def run(rows: pa.Table) -> pa.Table:
        shard_id = rows.column("shard")[0].as_py()
        keys = rows.column("key").to_pylist()
        ids = [_unpack(packed) for packed in rows.column("ids").to_pylist()]
        salts = rows.column("salt").to_pylist()
        order = sorted(range(len(keys)), key=lambda row: (keys[row] is None, keys[row] or 0, salts[row]))
        own = [ids[row] for row in order]
        pieces = list(fill_windows(own, rarity, mean, window))
        return pa.table({
            "key": pa.array([keys[order[p[0]]] for p in pieces], pa.int64()), "start": pa.array([p[1] for p in pieces], pa.int64()), "length": pa.array([p[2] for p in pieces], pa.int64()),
            "ids": pa.array([own[p[0]][p[1] : p[1] + p[2]].astype("<u4").tobytes() for p in pieces], pa.binary()), "doc_tokens": pa.array([len(own[p[0]]) for p in pieces], pa.int64()),
            "sequence_id": pa.array([(shard_id << 32) + p[3] for p in pieces], pa.int64()), "offset": pa.array([p[4] for p in pieces], pa.int64()),
        })

    schema = "key long, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long"
    return dealt.groupBy("shard").applyInArrow(run, schema).withColumnRenamed("key", key)
