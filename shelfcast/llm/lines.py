"""Removal of lines that nearly repeat an earlier one, by an exact set-similarity join; built-in expressions only.

A line is the set of its words (``[^\\x20\\x09-\\x0D]+``), ordered from rare to frequent by counts over all documents.
Two lines match from a Jaccard similarity of ``threshold`` on; a line goes if any earlier line (by doc_id, then
position) matches it, removed itself or not.  Lines of fewer than ``least`` different words stay; with 1, only those without a word.

Lines of the same set are one node.  Sets too small to match any but an equal one (1 to 3 words at 0.8) go no further.
Two other sets can match only if they share a gram, two neighbours in that order, near their rare ends: a word of x that
y lacks breaks two grams of x at most, a word that y has more breaks one, so the first common gram has few before it.
Grams that no two lines of like size share are dropped by one sorted pass; the rest are cut down by size and place, by
parity sketches (a set difference of d words changes at most d bits), then verified on the words themselves.  All
joins are semi-joins: they ask whether a match exists and never list the pairs of a group.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from shelfcast.llm.shared import materialise

BLANKS = r"[\x20\x09-\x0D]+"
#: Words are counted by a hash of so many values, so that the counts are bounded; a collision changes the order, not the result.
BUCKETS = 1 << 14
#: Bits of a gram's hash; a collision costs a comparison, no result.
GRAM = (1 << 40) - 1
#: Columns of the wide sketch, of 64 bits each.
SKETCH = ("s0", "s1", "s2", "s3")
#: Hash values that a broadcast filter ahead of an exchange holds at most.
FILTER = 1 << 21


def _rarity(documents: DataFrame) -> str:
    """For each bucket of words one of 16 classes from rare to frequent (two to a doubling), 16 buckets to a number."""
    words = documents.select(F.explode(F.split("text", BLANKS)).alias("word"))
    counted = words.groupBy(F.xxhash64("word").bitwiseAND(F.lit(BUCKETS - 1)).cast("int").alias("bucket")).agg(F.count("*").alias("n"))
    found = dict(map(tuple, counted.collect()))
    least = min(found.values()) if len(found) == BUCKETS else 1
    cells = [0] * (BUCKETS // 16)
    for bucket, n in found.items():
        cells[bucket % len(cells)] |= min(15, round(2 * math.log2(n / least))) << 4 * (bucket // len(cells))
    # the upper half of the classes must follow the lower one as signed numbers
    signed = [(cell ^ 0x8888888888888888) for cell in cells]
    return ",".join(str(cell - (1 << 64) if cell >> 63 else cell) for cell in signed)


def _words(line: Column, rarity: str) -> Column:
    """The different words of a line as numbers in the order of rarity: the class above 60 bits of hash."""
    cells = F.split(F.lit(rarity), ",").cast("array<bigint>")
    hashes = F.array_remove(F.array_distinct(F.transform(F.split(line, BLANKS), lambda word: F.xxhash64(word))), F.xxhash64(F.lit("")))

    def ranked(h: Column) -> Column:
        cell = F.coalesce(F.get(cells, h.bitwiseAND(F.lit(BUCKETS // 16 - 1)).cast("int")), F.lit(0).cast("long"))
        place = F.shiftright(h, (BUCKETS // 16).bit_length() - 3).bitwiseAND(F.lit(60)).cast("int")
        return F.shiftleft(F.call_function("shiftright", cell, place), 60).bitwiseOR(h.bitwiseAND(F.lit((1 << 60) - 1)))

    return F.sort_array(F.transform(hashes, ranked))


def _width(threshold: float) -> int:
    """Words to a gram: two if every set that may match another one has more grams than a match can break, else one."""
    if not 0.5 < threshold < 1:
        return 1
    sizes = range(max(1, math.ceil(threshold / (1 - threshold) - 1e-9)), math.ceil(2 / (2 * threshold - 1)) + 2)
    return 2 if all(math.floor(2 * n * (1 - threshold) + 1e-9) + 1 <= n - 1 for n in sizes) else 1


def _lines(documents: DataFrame) -> DataFrame:
    return documents.where("doc_id is not null").select("doc_id", F.posexplode(F.split("text", "\n")).alias("line", "content"))


def _parity(words: Column, part: int = 0, parts: int = 1) -> Column:
    """One of so many parts of a sketch: 64 bits, each the parity of the words that fall on it."""

    def bit(word: Column) -> Column:
        own = F.call_function("shiftleft", F.lit(1).cast("long"), word.bitwiseAND(F.lit(63)).cast("int"))
        return own if parts == 1 else F.when(F.pmod(F.shiftright(word, 6), F.lit(parts)) == part, own).otherwise(F.lit(0).cast("long"))

    return F.aggregate(words, F.lit(0).cast("long"), lambda bits, word: bits.bitwiseXOR(bit(word)))


def _signed(documents: DataFrame, rarity: str, threshold: float) -> DataFrame:
    """One row a line: doc_id, line, hash of its set (two columns), n, sketch, grams of its rare end (none if it matches only an equal set)."""
    rows = _lines(documents).select("doc_id", "line", _words(F.col("content"), rarity).alias("words"))
    n, width = F.size("words"), _width(threshold)
    count = F.when(n * (1 - threshold) >= threshold - 1e-9, F.floor(width * (1 - threshold) * n + 1e-9).cast("int") + 1).otherwise(0)
    if width == 1:
        grams = F.transform(F.slice("words", 1, count), lambda word: F.xxhash64(word).bitwiseAND(F.lit(GRAM)))
    else:
        grams = F.zip_with(F.slice("words", 1, count), F.slice("words", 2, count), lambda word, following: F.xxhash64(word, following).bitwiseAND(F.lit(GRAM)))
    return rows.select("doc_id", "line", F.xxhash64("words").alias("h"), F.hash("words").alias("g"), n.alias("n"), _parity(F.col("words")).alias("s"), grams.alias("grams"))


def _likely(rows: DataFrame, keys: DataFrame, *names: str) -> DataFrame:
    """The rows whose key may be among the keys: what a set of ``FILTER`` hash values lets pass."""
    cell = F.pmod(F.xxhash64(*names), F.lit(FILTER))
    return rows.withColumn("_cell", cell).join(F.broadcast(keys.select(cell.alias("_cell")).distinct()), "_cell", "left_semi").drop("_cell")


def _earlier(y: str, x: str) -> str:
    return f"({y}.doc_id < {x}.doc_id or {y}.doc_id = {x}.doc_id and {y}.line < {x}.line)"


def _need(threshold: float) -> str:
    return f"ceil({threshold} / (1 + {threshold}) * (x.n + y.n) - 1e-9)"


def _possible(threshold: float) -> str:
    """Whether lines x and y may match if the gram at place p of x and y is the first that they share."""
    need, width = _need(threshold), _width(threshold)
    return (
        f"least(x.n, y.n) >= {threshold} * greatest(x.n, y.n) - 1e-9"
        f" and x.p <= {width} * (x.n - {need}) + {width - 1} * (y.n - {need}) and y.p <= {width} * (y.n - {need}) + {width - 1} * (x.n - {need})"
    )


def _alike(threshold: float, *sketch: str) -> str:
    """Whether the sketches of lines x and y allow a match: one word changes one bit."""
    return f"{' + '.join(f'bit_count(x.{part} ^ y.{part})' for part in sketch)} <= x.n + y.n - 2 * {_need(threshold)}"


def _shared(grams: DataFrame, threshold: float) -> DataFrame:
    """The rows whose gram another row of like size has too: one exchange, one sort."""
    same = Window.partitionBy("gram").orderBy("n")
    near = grams.withColumns({"_below": F.lag("n").over(same), "_above": F.lead("n").over(same)})
    return near.where(f"_below >= {threshold} * n - 1e-9 or n >= {threshold} * _above - 1e-9").drop("_below", "_above")


def _meeting(left: DataFrame, right: DataFrame, condition: str, *, later: bool) -> DataFrame:
    """The rows of the left that are later (or earlier) than a row of the right with the same gram, under a condition on x and y."""
    x, y = ("x", "y") if later else ("y", "x")
    return left.alias(x).join(right.alias(y), F.expr(f"x.gram = y.gram and {_earlier('y', 'x')} and {condition}"), "left_semi")


def _sketched(later: DataFrame, met: DataFrame, sketches: DataFrame, condition: str) -> tuple[DataFrame, DataFrame]:
    """The later rows with an earlier one whose sketch is alike, and the rows that these meet, both without sketches."""
    names, whole = later.columns, ["doc_id", "line", "n"]
    later, met = later.join(sketches, whole), met.join(sketches, whole)
    later = materialise(_meeting(later, met, condition, later=True))
    return later.select(*names), materialise(_meeting(met, later, condition, later=False).select(*names))


def repeated_lines(documents: DataFrame, threshold: float = 0.8, least: int = 5) -> DataFrame:
    """(doc_id, line): the lines (counted from 0) of ``documents`` (doc_id, text) that match an earlier one.

    A null text has no lines; rows without a doc_id are left out; rows that repeat a doc_id are one document.
    """
    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text").where("text is not null")
    rarity = _rarity(rows)
    signed = materialise(_signed(rows, rarity, threshold)).where(F.col("n") >= least)

    # lines of the same set, of any size: the earliest stands for all
    sets = materialise(signed.groupBy("h", "g", "n").agg(F.min(F.struct("doc_id", "line")).alias("first"), F.count("*").alias("lines")).where("lines > 1").select("h", "g", "n", "first.*"))
    shared = _likely(signed, sets, "h", "g", "n")
    again = shared.alias("x").join(sets.alias("y"), F.expr(f"x.h = y.h and x.g = y.g and x.n = y.n and {_earlier('y', 'x')}"), "left_semi").select("doc_id", "line").distinct()
    again = materialise(again)
    cell = F.pmod(F.xxhash64("doc_id", "line"), F.lit(FILTER))
    marks = again.select(cell.alias("_cell")).distinct()
    # smaller sets, without grams, match equal ones only
    able = signed.where(F.size("grams") > 0)
    single = able.withColumn("_cell", cell).join(F.broadcast(marks), "_cell", "left_anti").drop("_cell")
    doubtful = _likely(able, again, "doc_id", "line").join(again, ["doc_id", "line"], "left_anti")
    leaders = single.unionByName(doubtful)

    # lines that share a gram with a line that they may match; of those the ones whose sketches are alike too
    possible, whole = _possible(threshold), ["doc_id", "line", "n"]
    near = materialise(_shared(leaders.select(*whole, F.posexplode("grams").alias("p", "gram")), threshold))
    other = f"x.gram = y.gram and (x.doc_id <> y.doc_id or x.line <> y.line) and {possible}"
    near = materialise(near.alias("x").join(near.alias("y"), F.expr(other), "left_semi"))
    later, met = _sketched(near, near, able.select(*whole, "s"), f"{possible} and {_alike(threshold, 's')}")

    # their words, from the texts
    wanted = materialise(later.select("doc_id", "line").union(met.select("doc_id", "line")).distinct())
    texts = _likely(rows, wanted.select("doc_id"), "doc_id")
    found = _likely(_lines(texts), wanted, "doc_id", "line").join(wanted, ["doc_id", "line"], "left_semi")
    found = found.select("doc_id", "line", _words(F.col("content"), rarity).alias("words")).distinct()
    parts = [_parity(F.col("words"), part, len(SKETCH)).alias(name) for part, name in enumerate(SKETCH)]
    written = materialise(found.select("doc_id", "line", F.size("words").alias("n"), "words", *parts))
    words = written.select(*whole, "words")
    # long lines look alike in 64 bits; few rows may travel with all their words
    later, met = _sketched(later, met, written.select(*whole, *SKETCH), f"{possible} and {_alike(threshold, *SKETCH)}")

    # first by one shared gram of each line; then those not yet proven, by all of them
    overlap = "size(array_intersect(x.words, y.words))"
    proven = f"{possible} and {overlap} * (1 + {threshold}) >= {threshold} * (x.n + y.n) - 1e-9"
    probe = later.groupBy(*whole).agg(F.min_by("gram", "p").alias("gram"), F.min("p").alias("p"))
    first = _meeting(probe.join(words, whole), _meeting(met, probe, possible, later=False).join(words, whole), proven, later=True)
    first = materialise(first.select("doc_id", "line").distinct())
    rest = materialise(later.join(first, ["doc_id", "line"], "left_anti"))
    met = materialise(_meeting(met, rest, possible, later=False))
    second = _meeting(rest.join(words, whole), met.join(words, whole), proven, later=True)
    second = materialise(second.select("doc_id", "line").distinct())
    return again.unionByName(first).unionByName(second).distinct()


def drop_repeated_lines(documents: DataFrame, threshold: float = 0.8, least: int = 5) -> DataFrame:
    """All rows and columns, ``text`` without the lines that match an earlier one, with n_lines and n_removed.

    The other lines stay as they are, in order.  A null text stays null with no lines, an empty one is one empty line;
    rows without a doc_id stay whole.  Columns named n_lines or n_removed are replaced.
    """
    kept = [name for name in documents.columns if name not in ("n_lines", "n_removed")]
    removed = repeated_lines(documents, threshold, least).groupBy("doc_id").agg(F.collect_set("line").alias("_removed"))
    removed = materialise(removed.withColumnRenamed("doc_id", "_doc"))
    rows = documents.select(*kept)
    cell = F.pmod(F.xxhash64(F.col("doc_id").cast("long")), F.lit(FILTER))
    touched = F.broadcast(removed.select(F.pmod(F.xxhash64("_doc"), F.lit(FILTER)).alias("_cell")).distinct())
    marked = rows.withColumn("_cell", F.coalesce(cell, F.lit(-1)))
    # documents that lose no line need not move
    whole = marked.join(touched, "_cell", "left_anti").drop("_cell").withColumn("_removed", F.array().cast("array<int>"))
    cut = marked.join(touched, "_cell", "left_semi").drop("_cell").join(removed, F.col("doc_id").cast("long") == F.col("_doc"), "left").drop("_doc")
    every = whole.unionByName(cut.withColumn("_removed", F.coalesce("_removed", F.array().cast("array<int>"))))
    left = F.array_join(F.filter(F.split("text", "\n"), lambda _, place: ~F.array_contains("_removed", place)), "\n")
    every = every.withColumns({
        "n_lines": F.when(F.col("text").isNull(), 0).otherwise(F.size(F.split("text", "\n"))).cast("long"), "n_removed": F.size("_removed").cast("long"),
        "text": F.when(F.size("_removed") > 0, left).otherwise(F.col("text")),
    })
    return every.select(*kept, "n_lines", "n_removed")


def oracle_sql(threshold: float = 0.8, least: int = 5) -> str:
    """The query's rows in DuckDB, every pair of lines that share a word being compared."""
    return f"""
WITH lines AS (SELECT doc_id, unnest(range(0, len(string_split(text, chr(10))))) AS line, unnest(string_split(text, chr(10))) AS content FROM documents WHERE text IS NOT NULL),
sets AS (SELECT doc_id, line, list_sort(list_distinct(list_filter(string_split_regex(content, '[\\x20\\x09-\\x0D]+'), lambda w: w <> ''))) AS words FROM lines),
nodes AS (SELECT words, len(words) AS n, min((doc_id, line)) AS first, row_number() OVER () AS node FROM sets WHERE len(words) >= {least} GROUP BY words),
tokens AS (SELECT node, n, first, unnest(words) AS word FROM nodes),
pairs AS (SELECT x.node FROM tokens x JOIN tokens y ON x.word = y.word AND y.first < x.first AND least(x.n, y.n) >= {threshold} * greatest(x.n, y.n) - 1e-9
    GROUP BY x.node, y.node, x.n, y.n HAVING count(*) * {1 + threshold} >= {threshold} * (x.n + y.n) - 1e-9),
gone AS (SELECT s.doc_id, s.line FROM sets s JOIN nodes USING (words) WHERE (s.doc_id, s.line) > first OR node IN (SELECT node FROM pairs)),
kept AS (SELECT l.doc_id, count(*) AS n_lines, count(g.line) AS n_removed, string_agg(CASE WHEN g.line IS NULL THEN content END, chr(10) ORDER BY l.line) AS text
    FROM lines l LEFT JOIN gone g ON l.doc_id = g.doc_id AND l.line = g.line GROUP BY l.doc_id)
SELECT d.doc_id, coalesce(n_lines, 0) AS n_lines, coalesce(n_removed, 0) AS n_removed, CASE WHEN n_lines IS NULL THEN d.text ELSE coalesce(k.text, '') END AS text
FROM documents d LEFT JOIN kept k ON d.doc_id = k.doc_id
"""
