"""Language identification by a blended-spectrum presence kernel, Nyström landmarks and kernel ridge regression.

A text is the set of its letter n-grams (n = 1 to 4, words set off by a blank), hashed to ``DIMENSIONS`` bits.  The
kernel of two texts is the number of bits they share over the geometric mean of their own numbers.  ``LANDMARKS``
labelled texts span the Nyström feature space; one-versus-rest ridge regression in it gives a weight for each language
and landmark.  Texts are scored in batches: presence matrix times landmark matrix, times weights.  A text of more than
``SEGMENT`` characters is cut into equal segments, since the bits of a very long one would all be set; its scores are the
means over all segments that have a letter.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from shelfcast.llm.codepoints import LETTER, classes, decode, mix
from shelfcast.llm.shared import chunks, map_batches, strings

DIMENSIONS, LANDMARKS = 8192, 160
#: Characters of a segment at most, and segments that are scored at once.
SEGMENT, _TOGETHER = 8192, 256
#: Labelled segments of a language that the regression is fitted on at most, of different documents first, taken by a hash.
SAMPLE = 600
ORDERS = (1, 2, 3, 4)
#: Languages up to which each gets the whole sample; of more, all are learned from smaller samples.
LANGUAGES = 200
_LETTER = re.compile(r"[^\W\d_]")
_tables: dict[str, np.ndarray] = {}


def _lower() -> np.ndarray:
    """Lower case of every letter, a blank for everything else."""
    if "lower" not in _tables:
        kind = classes()
        table = np.full(0x110000, 0x20, dtype=np.uint32)
        for point in np.flatnonzero(kind == LETTER).tolist():
            table[point] = ord(chr(point).lower()[:1])
        _tables["lower"] = table
    return _tables["lower"]


def presence(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """A 0/1 matrix of the n-grams of each text, scaled to length one, and whether each text has a letter."""
    points, starts = decode([f" {text} " for text in texts])
    letters = _lower()[points]
    blank = letters == 0x20
    keep = np.ones(len(letters), dtype=bool)
    keep[1:] = ~(blank[1:] & blank[:-1])
    keep[starts[:-1]] = True
    owner = np.repeat(np.arange(len(texts)), np.diff(starts))[keep]
    letters = letters[keep].astype(np.uint64)
    has = np.bincount(owner[letters != 0x20], minlength=len(texts)) > 0
    found = np.zeros((len(texts), DIMENSIONS), dtype=bool)
    flat = found.reshape(-1)
    gram = np.zeros(len(letters), dtype=np.uint64)
    base = owner.astype(np.int64) * DIMENSIONS
    for order in ORDERS:
        gram = gram[: len(letters) - order + 1] * np.uint64(0x110000) + letters[order - 1 :]
        if not len(gram):
            break
        same = owner[: len(gram)] == owner[order - 1 :]
        cell = (mix(gram + np.uint64(order)) & np.uint64(DIMENSIONS - 1)).astype(np.int64)
        flat[(base[: len(gram)] + cell)[same]] = True
    # an n-gram of blanks alone says nothing
    matrix = found.astype(np.float32)
    return matrix / np.maximum(np.sqrt(matrix.sum(axis=1, keepdims=True)), 1), has


def segments(text: str) -> list[str]:
    """The whole text in parts of about the same length, of ``SEGMENT`` characters at most."""
    size = -(-len(text) // max(1, -(-len(text) // SEGMENT)))
    return [text[at : at + size] for at in range(0, len(text), size)] if text else [""]


@dataclass
class Languages:
    """Names in order, landmark matrix, and the weight of each landmark for each language."""

    names: list[str]
    landmarks: np.ndarray
    weights: np.ndarray

    def rate(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Best language, its share of the softened scores, and whether each text has a letter."""
        if self.weights.shape[1] == 0:
            return np.zeros(len(texts), dtype=np.int64), np.zeros(len(texts)), np.zeros(len(texts), dtype=bool)
        parts = [segments(text) for text in texts]
        owner = np.repeat(np.arange(len(texts)), [len(own) for own in parts])
        every = [part for own in parts for part in own]
        scores, count = np.zeros((len(texts), self.weights.shape[1])), np.zeros(len(texts), dtype=np.int64)
        for at in range(0, len(every), _TOGETHER):
            matrix, letters = presence(every[at : at + _TOGETHER])
            own = owner[at : at + _TOGETHER][letters]
            np.add.at(scores, own, ((matrix @ self.landmarks.T) @ self.weights)[letters])
            np.add.at(count, own, 1)
        scores, has = scores / np.maximum(count, 1)[:, None], count > 0
        raised = np.exp(6 * (scores - scores.max(axis=1, keepdims=True)))
        return scores.argmax(axis=1), (raised / raised.sum(axis=1, keepdims=True)).max(axis=1), has


def _fit(texts: list[str], labels: list[str], landmarks: int, ridge: float) -> Languages:
    names = sorted(set(labels))
    rows = np.concatenate([presence(texts[at : at + 64])[0] for at in range(0, len(texts), 64)])
    target = np.where(np.array(labels)[:, None] == np.array(names)[None, :], 1.0, -1.0)
    # landmarks: as many of each language, in the order of the sample
    place = {name: [row for row, label in enumerate(labels) if label == name] for name in names}
    per = max(1, landmarks // len(names))
    chosen = sorted(row for name in names for row in place[name][:per])
    marks = rows[chosen]
    inner = (marks @ marks.T).astype(np.float64)
    values, vectors = np.linalg.eigh(inner)
    kept = values > 1e-6 * values.max()
    root = vectors[:, kept] / np.sqrt(values[kept])
    features = (rows @ marks.T).astype(np.float64) @ root
    balance = 1 / np.array([len(place[label]) for label in labels], dtype=np.float64)
    weighted = features * balance[:, None]
    solution = np.linalg.solve(features.T @ weighted + ridge * len(names) / len(rows) * np.eye(features.shape[1]), weighted.T @ target)
    return Languages(names, marks.astype(np.float32), (root @ solution).astype(np.float32))


def learn(documents: DataFrame, sample: int = SAMPLE, landmarks: int = LANDMARKS, ridge: float = 0.1) -> Languages:
    """A model of all languages of the documents (doc_id, text, lang) that have a language and a text with a letter.

    At most ``sample`` segments of each language are learned from, less if there are more than ``LANGUAGES``: one of
    each document by a hash, and more of a document only if there are too few others.
    """
    rows = documents.where("lang is not null and text is not null").select("lang", "text", F.xxhash64("doc_id", "text").alias("order"))
    found = rows.groupBy("lang").count().collect()
    if not found:
        return Languages([], np.zeros((0, DIMENSIONS), dtype=np.float32), np.zeros((0, 0), dtype=np.float32))
    sample = max(1, sample * LANGUAGES // max(LANGUAGES, len(found)))
    # about eight times the sample of each language by the hash's least values, then exactly the sample
    cuts = [(row["lang"], int(-(2**63) + min(1.0, 8.0 * sample / row["count"]) * (2**64 - 2048))) for row in found]
    few = rows.join(F.broadcast(documents.sparkSession.createDataFrame(cuts, "lang string, cut long")), "lang").where("order <= cut")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches, "text", 1 << 20):
            for lang, order, text in zip(*(batch.column(name).to_pylist() for name in ("lang", "order", "text")), strict=True):
                parts = [part for part in segments(text) if _LETTER.search(part)]
                if not parts:
                    continue
                # the segment of turn 0 is any one by the hash; no document can give more than the sample
                turns = range(min(len(parts), sample))
                own = [parts[(order + turn) % len(parts)] for turn in turns]
                yield pa.record_batch([pa.array([lang] * len(own), pa.string()), pa.array([order] * len(own), pa.int64()), pa.array(turns, pa.int32()), pa.array(own, pa.string())], ["lang", "order", "turn", "text"])

    pieces = map_batches(few.select("lang", "order", "text"), cut, "lang string, order long, turn int, text string").distinct()
    ranked = pieces.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy("turn", "order", "text"))).where(F.col("rank") <= sample)
    taken = ranked.select("lang", "turn", "order", "text").orderBy("lang", "turn", "order", "text").collect()
    texts, labels = [row["text"] for row in taken], [row["lang"] for row in taken]
    if not texts:
        return Languages([], np.zeros((0, DIMENSIONS), dtype=np.float32), np.zeros((0, 0), dtype=np.float32))
    return _fit(texts, labels, landmarks, ridge)


def identify(documents: DataFrame, model: Languages, text: str = "text") -> DataFrame:
    """All rows and columns with ``lang_pred`` and ``score`` (0 to 1) of the whole text; columns of those names are replaced.

    ``und`` with a score of 0 where the text is null or has no letter, or nothing was learned.  Of languages that score
    alike the alphabetically first is given.  Each row is rated by itself: repeated rows get the same result each, an
    empty table gives none.
    """
    kept = [name for name in documents.columns if name not in ("lang_pred", "score")]
    source = documents.select(*kept)
    schema = ", ".join(f"`{name}` {kind}" for name, kind in source.dtypes) + ", lang_pred string, score double"
    shared = documents.sparkSession.sparkContext.broadcast(model)  # bounded: LANDMARKS rows, LANGUAGES columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        for batch in chunks(batches, text, 1 << 18):
            best, share, has = known.rate(strings(batch, text))
            names = [known.names[k] if ok else "und" for k, ok in zip(best, has, strict=True)]
            columns = [*batch.columns, pa.array(names, pa.string()), pa.array(np.where(has, share, 0.0).astype(np.float64))]
            yield pa.RecordBatch.from_arrays(columns, names=[*batch.schema.names, "lang_pred", "score"])

    return map_batches(source, run, schema)
