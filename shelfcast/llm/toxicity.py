"""Toxicity by a weighted lexicon, matched with an Aho-Corasick automaton over folded text.

Folding lowers case, takes plain letters for full-width and look-alike letters, reads digits and signs inside words as
the letters they stand for, drops invisible and combining marks, and turns everything else into single blanks.  The lexicon
(word starts and whole words) and its weights are learned from labelled documents: log odds of a pattern in toxic
against clean documents, kept where the evidence for them is more than chance gives among so many patterns.  A hit inside an
exception phrase (a neighbour with which the pattern is found in clean documents only, or a phrase that is given) does
not count.  The score is a logistic function of the summed weights and of that sum by length.
"""

from __future__ import annotations

import math
import unicodedata
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfcast.llm.codepoints import decode
from shelfcast.llm.shared import chunks, map_batches, strings

#: Letters of other scripts and the Latin letters that they look like.
LOOKALIKES = "аa вb еe кk мm нh оo рp сc тt уy хx іi јj ѕs ԁd ԛq ԝw һh ӏl αa βb εe ηn ιi κk νv οo ρp τt υu χx ıi ɑa ɡg ℓl"
#: Digits and signs and the letters that they stand for inside a word.
SUBSTITUTES = "0o 1i 3e 4a 5s 7t 8b @a $s !i"
#: Labelled documents that the lexicon is learned from at most, taken by a hash of their id.
SAMPLE = 20_000
PREFIXES = range(4, 9)
_BLANK, _DROP, _MAYBE = 0x20, 0, 1
_tables: dict[str, np.ndarray] = {}


def _fold_tables() -> tuple[np.ndarray, np.ndarray]:
    """For every code point: what it folds to (0 to drop it), and the letter it stands for inside a word (0 if none)."""
    if "plain" not in _tables:
        plain, inside = np.full(0x110000, _BLANK, dtype=np.uint32), np.zeros(0x110000, dtype=np.uint32)
        alike = dict(pair for pair in LOOKALIKES.split(" "))
        for point in (*range(0xD800), *range(0xE000, 0x20000)):
            char = chr(point)
            kind = unicodedata.category(char)
            if kind in ("Mn", "Cf"):
                plain[point] = _DROP
            elif kind[0] in "LN":
                low = char.lower()[:1]
                base = unicodedata.normalize("NFKC", low)[:1]
                plain[point] = ord(alike.get(base, base).lower()[:1])
        plain[0x20000:] = [ord(chr(point)) if chr(point).isalpha() else _BLANK for point in range(0x20000, 0x110000)]
        for sign, letter in SUBSTITUTES.split(" "):
            inside[ord(sign)] = ord(letter)
        _tables["plain"], _tables["inside"] = plain, inside
    return _tables["plain"], _tables["inside"]


def fold(texts: list[str]) -> list[str]:
    """Folded texts: words of letters and digits between single blanks, with a blank before and after each."""
    plain, inside = _fold_tables()
    points, starts = decode([f" {text} " for text in texts])
    folded = plain[points]
    letter = (folded != _BLANK) & (folded != _DROP) & ~((points >= 0x30) & (points <= 0x39))
    after, before = np.zeros(len(points), dtype=bool), np.zeros(len(points), dtype=bool)
    sign = inside[points] > 0
    # a sign is read as a letter if the run of signs that it is in has a letter behind it; a digit, if on either side
    digit = (points >= 0x30) & (points <= 0x39)
    places = np.arange(len(points))
    next_solid = np.minimum.accumulate(np.where(sign, len(points) - 1, places)[::-1])[::-1]
    last_solid = np.maximum.accumulate(np.where(sign, 0, places))
    after, before = letter[next_solid], letter[last_solid]
    read = sign & (after | digit & before)
    folded = np.where(read, inside[points], folded)
    blank = folded == _BLANK
    keep = folded != _DROP
    keep[1:] &= ~(blank[1:] & blank[:-1])
    keep[starts[:-1]] = True
    bounds = np.concatenate(([0], np.cumsum(keep)))[starts]
    every = folded[keep].astype("<u4").tobytes().decode("utf-32-le")
    return [every[a:b] for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True)]


def _patterns(folded: str) -> set[str]:
    found = set()
    for word in set(folded.split()):
        found.add(f" {word} ")
        for length in PREFIXES:
            if len(word) > length:
                found.add(f" {word[:length]}")
    return found


@dataclass
class Lexicon:
    """Weights of patterns, exception phrases (pattern or phrase between blanks), and the logistic coefficients."""

    weights: dict[str, float]
    exceptions: list[str] = field(default_factory=list)
    coefficients: tuple[float, float, float] = (-4.0, 1.0, 1.0)

    def automaton(self) -> ahocorasick.Automaton | None:
        found = ahocorasick.Automaton()
        for phrase in self.exceptions:
            found.add_word(phrase, (len(phrase), None))
        for pattern, weight in self.weights.items():
            found.add_word(pattern, (len(pattern), weight))
        if not len(found):
            return None
        found.make_automaton()
        return found


def _sums(lexicon: Lexicon, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Summed weights of the hits outside exceptions, and words, of each text."""
    automaton = lexicon.automaton()
    total, words = np.zeros(len(texts)), np.zeros(len(texts))
    for row, text in enumerate(fold(texts)):
        words[row] = text.count(" ")
        if automaton is None:
            continue
        hits = [(end - length + 1, end, weight) for end, (length, weight) in automaton.iter(text)]
        spared = [(a, b) for a, b, weight in hits if weight is None]
        total[row] = sum(w for a, b, w in hits if w is not None and not any(x <= a and b <= y for x, y in spared))
    return total, words


def _inputs(total: np.ndarray, words: np.ndarray) -> np.ndarray:
    return np.column_stack((np.ones(len(total)), np.log1p(total), np.log1p(1000 * total / (words + 50))))


def _fit(inputs: np.ndarray, label: np.ndarray) -> tuple[float, float, float]:
    """Coefficients of a lightly ridged logistic regression, by Newton's method."""
    weights = np.zeros(inputs.shape[1])
    ridge = np.diag([1e-3, 1e-2, 1e-2])
    for _ in range(50):
        chance = 1 / (1 + np.exp(-np.clip(inputs @ weights, -30, 30)))
        step = np.linalg.solve((inputs * (chance * (1 - chance))[:, None]).T @ inputs + ridge, inputs.T @ (label - chance) - ridge @ weights)
        weights += step
        if np.abs(step).max() < 1e-9:
            break
    return tuple(float(value) for value in weights)


def _count(labelled: DataFrame, wanted: set[str] | None) -> DataFrame:
    """(pattern, label, documents): in how many documents of each label a pattern is found; wanted limits the patterns."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[int, Counter] = {0: Counter(), 1: Counter()}
        for batch in chunks(batches, "text", 1 << 20):
            for text, label in zip(fold(strings(batch, "text")), batch.column("label").to_pylist(), strict=True):
                patterns = _patterns(text)
                found[label].update(patterns if wanted is None else patterns & wanted)
        for label, counts in found.items():
            names = list(counts)
            for at in range(0, len(names), 10_000):
                some = names[at : at + 10_000]
                yield pa.record_batch(
                    [pa.array(some, pa.string()), pa.array([label] * len(some), pa.int32()), pa.array([counts[name] for name in some], pa.int64())], ["pattern", "label", "documents"]
                )

    return map_batches(labelled, run, "pattern string, label int, documents long").groupBy("pattern", "label").agg(F.sum("documents").alias("documents"))


def _neighbours(labelled: DataFrame, weights: dict[str, float]) -> DataFrame:
    """(phrase, label, documents): a hit's word with the word before or behind it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = Lexicon(weights).automaton()
        for batch in chunks(batches, "text", 1 << 20):
            phrases, labels = [], []
            for text, label in zip(fold(strings(batch, "text")), batch.column("label").to_pylist(), strict=True):
                own = set()
                for end, (length, _) in automaton.iter(text):
                    start = end - length + 1
                    stop = text.find(" ", start + 1)
                    behind = text.find(" ", stop + 1) if stop >= 0 else -1
                    if behind > 0:
                        own.add(text[start : behind + 1])
                    ahead = text.rfind(" ", 0, start)
                    if ahead >= 0 and stop >= 0:
                        own.add(text[ahead : stop + 1])
                phrases.extend(own)
                labels.extend([label] * len(own))
            yield pa.record_batch([pa.array(phrases, pa.string()), pa.array(labels, pa.int32())], ["phrase", "label"])

    return map_batches(labelled, run, "phrase string, label int").groupBy("phrase", "label").agg(F.count("*").alias("documents"))


def _evidence(toxic: int, clean: int, all_toxic: int, all_clean: int) -> float:
    """Log-likelihood ratio of a pattern and the label against independence."""
    share = (toxic + clean) / (all_toxic + all_clean)
    cells = ((toxic, all_toxic * share), (clean, all_clean * share), (all_toxic - toxic, all_toxic * (1 - share)), (all_clean - clean, all_clean * (1 - share)))
    return 2 * sum(seen * math.log(seen / expected) for seen, expected in cells if seen > 0 and expected > 0)


def learn(documents: DataFrame, labels: DataFrame, sample: int = SAMPLE, least: int = 4, least_odds: float = 1.5, margin: float = 4.0, given: tuple[str, ...] = ()) -> Lexicon:
    """A lexicon from documents (doc_id, text) and labels (doc_id, toxic 0 or 1; the higher of repeated ones counts).

    At most ``sample`` labelled documents are read.  Without toxic or without clean ones the lexicon is empty.
    """
    rows = labels.where("doc_id is not null and toxic in (0, 1)").groupBy("doc_id").agg(F.max("toxic").cast("int").alias("label"))
    chosen = rows.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
    labelled = documents.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").select("text", "label")
    sizes = {row["label"]: row["count"] for row in labelled.groupBy("label").count().collect()}
    if len(sizes) < 2:
        return Lexicon({}, [f" {phrase.strip()} " for phrase in fold(list(given))])
    toxic = {row["pattern"]: row["documents"] for row in _count(labelled.where("label = 1"), None).where(F.col("documents") >= least).collect()}
    clean = {row["pattern"]: row["documents"] for row in _count(labelled.where("label = 0"), set(toxic)).collect()}
    odds = {}
    for pattern, often in toxic.items():
        other = clean.get(pattern, 0)
        value = math.log((often + 0.5) / (sizes[1] + 1)) - math.log((other + 0.5) / (sizes[0] + 1))
        evidence = _evidence(often, other, sizes[1], sizes[0])
        # what the best of so many patterns reaches by chance is about twice the logarithm of their number
        if value >= least_odds and evidence >= 2 * math.log(len(toxic)) + margin:
            odds[pattern] = (evidence, value)  # of nested patterns the strongest stays
    weights: dict[str, float] = {}
    for pattern in sorted(odds, key=lambda name: (-odds[name][0], name)):
        stem = pattern.rstrip()
        starts = {stem[:length] for length in range(2, len(stem) + 1)}
        if not starts & weights.keys() and pattern not in weights and not any(taken.startswith(stem) for taken in weights):
            weights[pattern] = odds[pattern][1]
    phrases: dict[str, dict[int, int]] = {}
    if weights:
        for row in _neighbours(labelled, weights).where("documents >= 3").collect():
            phrases.setdefault(row["phrase"], {})[row["label"]] = row["documents"]
    exceptions = [phrase for phrase, seen in phrases.items() if 0 in seen and 1 not in seen] + [f" {phrase.strip()} " for phrase in fold(list(given))]
    lexicon = Lexicon(weights, exceptions)

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches, "text", 1 << 20):
            total, words = _sums(lexicon, strings(batch, "text"))
            yield pa.record_batch([pa.array(total), pa.array(words), batch.column("label")], ["total", "words", "label"])

    seen = map_batches(labelled, measure, "total double, words double, label int").toPandas()
    lexicon.coefficients = _fit(_inputs(seen["total"].to_numpy(), seen["words"].to_numpy()), seen["label"].to_numpy().astype(float))
    return lexicon


def score(documents: DataFrame, lexicon: Lexicon, text: str = "text") -> DataFrame:
    """All rows and columns with a ``score`` from 0 to 1 of the whole text (null: empty); a column of that name is replaced.

    An empty text gets the score of a text without hits.  Very long texts are read whole, one at a time.  Each row is
    scored by itself: repeated rows get the same score each, ties are left as they are, an empty table gives none.
    """
    kept = [name for name in documents.columns if name != "score"]
    source = documents.select(*kept)
    schema = ", ".join(f"`{name}` {kind}" for name, kind in source.dtypes) + ", score double"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights = np.array(lexicon.coefficients)
        for batch in chunks(batches, text, 1 << 20):
            total, words = _sums(lexicon, strings(batch, text))
            chance = 1 / (1 + np.exp(-np.clip(_inputs(total, words) @ weights, -30, 30)))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(chance)], names=[*batch.schema.names, "score"])

    return map_batches(source, run, schema)
