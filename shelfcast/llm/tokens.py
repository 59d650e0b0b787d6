"""Byte-level BPE over a global shuffle of distinct words, and decoding.

Texts are cut into pre-tokens in blocks of about ``BLOCK_TOKENS``.  A block lists its distinct pre-tokens once and
holds its documents as places in that list.  The lists of all blocks are exploded and exchanged by pre-token, so that
each distinct one is merged once; its ids go back to the blocks that hold it (a frequent pre-token travels once a
block, not once an occurrence), and each block reassembles its documents by position.  Pre-tokens are told apart by
their bytes.

Texts are read twice, for the lists and for the documents.  Input that may come in another order when it is read again
(behind a shuffle) is written to the shared folder first; a block is named by its content, so that two readings that
differ fail and never exchange ids.

Null and empty texts give no ids.  Repeated rows and repeated keys give one result each; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfcast.llm import bpe
from shelfcast.llm.codepoints import decode, distinct_spans
from shelfcast.llm.shared import chunks, map_batches, materialise, strings

#: Pre-tokens in a block, and UTF-8 bytes of text handled at once.
BLOCK_TOKENS, CHUNK_BYTES = 6_000_000, 1 << 19


def _distinct(texts: list[str]) -> tuple[np.ndarray, np.ndarray, list[bytes]]:
    """How many pre-tokens each text has, the number of each in the list of distinct ones, and that list."""
    points, starts = decode(texts)
    begin = bpe.split_spaced(points, starts)
    end = np.append(begin[1:], len(points))
    codes, first = distinct_spans(points, begin, end)
    every = "".join(texts)
    pieces = [every[a:b].encode() for a, b in zip(begin[first].tolist(), end[first].tolist(), strict=True)]
    return np.diff(np.searchsorted(begin, starts)), codes, pieces


def _blocks(what: str):
    """Blocks of documents: ``words`` gives their pre-tokens with a place, ``documents`` the documents as places."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place_of_task, ordinal = TaskContext.get().partitionId(), 0
        keys: list[int] = []
        counts, codes, known = [], [], {}
        content, held = xxhash.xxh64(), 0

        def block() -> Iterator[pa.RecordBatch]:
            content.update(f"{place_of_task} {ordinal} {keys}".encode())
            number = content.intdigest() - (1 << 63)
            flat, words = np.concatenate(codes), list(known)
            often = np.bincount(flat, minlength=len(words))
            by_count = np.argsort(-often, kind="stable")
            if what == "words":
                for at in range(0, len(words), 20_000):
                    some = by_count[at : at + 20_000]
                    place = np.arange(at, at + len(some), dtype=np.int32)
                    columns = [pa.array([words[row] for row in some], pa.binary()), pa.array(np.full(len(some), number)), pa.array(place)]
                    yield pa.record_batch(columns, ["word", "block", "place"])
                return
            rank = np.empty(len(words), dtype=np.uint32)
            rank[by_count] = np.arange(len(words), dtype=np.uint32)
            planes = zstandard.compress(np.ascontiguousarray(rank[flat].view(np.uint8).reshape(-1, 4).T).tobytes(), 3)
            each = np.concatenate(counts).astype(np.int32)
            yield pa.record_batch(
                [pa.array([number]), pa.array([keys], pa.list_(pa.int64())), pa.array([each], pa.list_(pa.int32())), pa.array([planes], pa.binary())],
                ["block", "keys", "counts", "codes"],
            )

        for batch in chunks(batches, "text", CHUNK_BYTES):
            texts = strings(batch, "text")
            for text in texts:
                content.update(text.encode())
                content.update(b"\xff")
            each, local, pieces = _distinct(texts)
            place = np.fromiter((known.setdefault(piece, len(known)) for piece in pieces), dtype=np.uint32, count=len(pieces))
            keys.extend(batch.column("key").to_pylist())
            counts.append(each)
            codes.append(place[local])
            held += len(local)
            if held >= BLOCK_TOKENS:
                yield from block()
                keys, counts, codes, known, held, ordinal, content = [], [], [], {}, 0, ordinal + 1, xxhash.xxh64()
        if keys:
            yield from block()

    return run


def _merge_words(path: str):
    """Ids of the distinct words of each batch, packed by block: places, numbers of ids, ids."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            coded = batch.column("word").dictionary_encode()
            ids, counts = bpe.encode_pieces(path, coded.dictionary.to_pylist())
            first = np.cumsum(counts) - counts
            code, block, place = (column.to_numpy() for column in (coded.indices, batch.column("block"), batch.column("place")))
            order = np.argsort(block, kind="stable")
            names, begin = np.unique(block[order], return_index=True)
            packed = []
            for own in np.split(order, begin[1:]):
                size = counts[code[own]]
                at = np.repeat(first[code[own]] - (np.cumsum(size) - size), size) + np.arange(size.sum())
                parts = (np.array([len(own)], dtype=np.int32), place[own].astype(np.int32), size.astype(np.int32), ids[at].astype(np.int32))
                packed.append(zstandard.compress(np.ascontiguousarray(np.concatenate(parts).view(np.uint8).reshape(-1, 4).T).tobytes(), 1))
            yield pa.record_batch([pa.array(names), pa.array(packed, pa.binary())], ["block", "packed"])

    return run


def _unpacked(packed: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.decompress(packed), dtype=np.uint8)
    return np.ascontiguousarray(planes.reshape(4, -1).T).view(np.int32).ravel()


def _assemble(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in range(batch.num_rows):
            one = batch.slice(row, 1)
            parts = [_unpacked(packed) for packed in one.column("pieces")[0].as_py()]
            place = np.concatenate([np.zeros(0, dtype=np.int32), *(part[1 : part[0] + 1] for part in parts)])
            size = np.concatenate([np.zeros(0, dtype=np.int32), *(part[part[0] + 1 : 2 * part[0] + 1] for part in parts)])
            ids = np.concatenate([np.zeros(0, dtype=np.int32), *(part[2 * part[0] + 1 :] for part in parts)])
            begin, length = np.zeros(len(place), dtype=np.int64), np.zeros(len(place), dtype=np.int64)
            begin[place], length[place] = np.cumsum(size) - size, size
            codes = _unpacked(one.column("codes")[0].as_py())
            if codes.size and codes.max() >= len(place):
                raise RuntimeError("the documents came in another order when they were read again: write them first (stable=False)")
            counts = one.column("counts").flatten().to_numpy(zero_copy_only=False)
            keys = one.column("keys").flatten()
            ends = np.concatenate(([0], np.cumsum(counts)))
            at = 0
            while at < len(keys):
                to = max(at + 1, int(np.searchsorted(ends, ends[at] + 300_000, side="right")) - 1)
                own = codes[ends[at] : ends[to]]
                sizes = length[own]
                total = np.concatenate(([0], np.cumsum(sizes)))
                flat = ids[np.repeat(begin[own] - total[:-1], sizes) + np.arange(total[-1])]
                bounds = total[ends[at : to + 1] - ends[at]].astype(np.int32)
                yield pa.record_batch([keys.slice(at, to - at), pa.ListArray.from_arrays(pa.array(bounds), pa.array(flat))], ["key", "ids"])
                at = to


def _in_blocks(documents: DataFrame, ranks: str, key: str, text: str, stable: bool) -> DataFrame:
    """Blocks of documents as places, with the ids of the block's pre-tokens."""
    rows = documents.select(F.col(key).cast("long").alias("key"), F.col(text).alias("text"))
    if not stable:
        rows = materialise(rows)
    words = map_batches(rows, _blocks("words"), "word binary, block long, place int")
    # one exchange brings every occurrence of a word together; sorted, it is merged once
    sorted_words = words.repartition("word").sortWithinPartitions("word")
    pieces = map_batches(sorted_words, _merge_words(ranks), "block long, packed binary").groupBy("block").agg(F.collect_list("packed").alias("pieces"))
    blocks = map_batches(rows, _blocks("documents"), "block long, keys array<long>, counts array<int>, codes binary")
    return blocks.join(pieces, "block", "left").select("keys", "counts", "codes", F.coalesce("pieces", F.array().cast("array<binary>")).alias("pieces"))


def encode(documents: DataFrame, ranks: str, key: str = "doc_id", text: str = "text", stable: bool = False) -> DataFrame:
    """(key, ids): the ids of each text by the rank file ``ranks``, each match of its pattern merged by itself.

    Equal to encoding text by text.  The key is a long; an empty table gives an empty result.  ``stable`` says that
    the rows come in the same order whenever they are read, as those of a file scan do, and need not be written first.
    """
    return map_batches(_in_blocks(documents, ranks, key, text, stable), _assemble, "key long, ids array<int>").withColumnRenamed("key", key)


def _decoded(ranks: str):
    """Batches (key, ids) with the bytes that the ids stand for."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = bpe.token_bytes(ranks)
        for batch in batches:
            rows = batch.column("ids")
            values, offsets = rows.flatten().to_numpy(zero_copy_only=False), rows.offsets.to_numpy()
            offsets = offsets - offsets[0]
            joined = table.take(pa.array(values))
            data = joined.buffers()[2]
            bounds = np.frombuffer(joined.buffers()[1], dtype=np.int32)[: len(joined) + 1][offsets].astype(np.int32)
            out = pa.Array.from_buffers(pa.binary(), len(rows), [None, pa.py_buffer(bounds), data])
            yield pa.record_batch([batch.column("key"), rows, out], ["key", "ids", "bytes"])

    return run


def decode_ids(encoded: DataFrame, ranks: str, key: str = "doc_id", ids: str = "ids") -> DataFrame:
    """(key, ids, bytes): the ids and the bytes that they stand for, from the table of token bytes (bounded by the vocabulary)."""
    rows = encoded.select(F.col(key).cast("long").alias("key"), F.col(ids).alias("ids"))
    return map_batches(rows, _decoded(ranks), "key long, ids array<int>, bytes binary").withColumnRenamed("key", key)


def round_trip(documents: DataFrame, ranks: str, key: str = "doc_id", text: str = "text", stable: bool = False) -> DataFrame:
    """(key, ids, bytes): ``encode`` and ``decode_ids`` in the same Python workers, half as many as one after the other."""
    decoded = _decoded(ranks)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return decoded(_assemble(batches))

    return map_batches(_in_blocks(documents, ranks, key, text, stable), run, "key long, ids array<int>, bytes binary").withColumnRenamed("key", key)
