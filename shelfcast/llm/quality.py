"""Quality rules with risk-controlled thresholds; built-in expressions only.

Every rule rejects documents whose measure lies above a cutoff.  For each stratum (language) and rule the strictest
cutoff of a fixed grid is taken whose false-rejection rate is proven to stay below ``RISK`` shared among the rules: on
the labelled good documents of the stratum, the exact binomial probability of seeing so few rejections at that rate
must not exceed ``DELTA`` shared among all strata, rules and cutoffs tested (Bonferroni).  Too few labels prove
nothing, and then only the base rules reject.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfcast.llm.shared import materialise

BLANKS = r"[\x20\x09-\x0D]+"
#: Share of good documents of a stratum that the rules together may reject, and the chance that this does not hold.
RISK, DELTA = 0.02, 0.05
#: Rules: measure (reject above) and grid of cutoffs.
GRIDS: dict[str, tuple[float, ...]] = {
    "symbols_per_word": (0.02, 0.05, 0.1, 0.2, 0.5, 1.0),
    "repeat_share": (0.05, 0.1, 0.15, 0.2, 0.3, 0.4),
    "dup_line_share": (0.05, 0.1, 0.2, 0.3, 0.5),
    "marks_per_word": (0.02, 0.05, 0.1, 0.2, 0.5, 1.0),
    "long_words": (7.0, 8.0, 9.0, 10.0, 12.0, 15.0),
}
#: Terms of a binomial tail that are added one by one; a bound stands for those below.
_TERMS = 4000


def _let(value: Column, body) -> Column:
    """``body`` of a value that is computed once for the row."""
    return F.transform(F.array(value), body)[0]


def _count(text: Column, signs: str) -> Column:
    """How often any of the ASCII signs comes in a text."""
    total = F.lit(0)
    for sign in signs:
        total = total + F.octet_length(text) - F.octet_length(F.replace(text, F.lit(sign), F.lit("")))
    return total


def _repeat_words(words: Column) -> Column:
    """Words that lie in a window of three which comes twice or more; windows are compared by a 64-bit hash."""

    def covered(ordered: Column) -> Column:
        again = F.filter(
            ordered,
            lambda window, at: ((at > 0) & (F.get(ordered, at - 1)["value"] == window["value"])) | (F.get(ordered, at + 1)["value"] == window["value"]),
        )
        places = F.sort_array(F.transform(again, lambda window: window["place"]))
        start = F.struct(F.lit(-3).alias("last"), F.lit(0).alias("words"))
        step = lambda state, place: F.struct(place.alias("last"), (state["words"] + F.least(F.lit(3), place - state["last"])).alias("words"))
        return F.aggregate(places, start, step, lambda state: state["words"])

    def windows(own: Column) -> Column:
        each = lambda at: F.struct(F.xxhash64(F.get(own, at), F.get(own, at + 1), F.get(own, at + 2)).alias("value"), at.alias("place"))
        return F.sort_array(F.transform(F.sequence(F.lit(0), F.size(own) - 3), each))

    return F.when(F.size(words) >= 3, _let(windows(words), covered)).otherwise(0)


def measure(documents: DataFrame, text: str = "text") -> DataFrame:
    """All rows and columns with the base counts of the whole text: n_words, word_chars, n_symbols, n_dup_lines,
    n_repeat_words, base_failed, and the measures of the rules.  A null text has no words; columns of those names are replaced."""
    plain = F.coalesce(F.col(text), F.lit(""))

    def counts(words: Column) -> Column:
        return F.struct(F.size(words).cast("long").alias("n_words"), _repeat_words(words).cast("long").alias("n_repeat_words"))

    words = F.filter(F.split(plain, BLANKS), lambda word: word != "")
    lines = F.filter(F.split(plain, "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]"))
    sizes = _let(lines, lambda own: F.struct(F.size(own).alias("lines"), (F.size(own) - F.size(F.array_distinct(own))).alias("again")))
    found = documents.withColumns({
        "_words": _let(words, counts), "_lines": sizes,
        "word_chars": (F.char_length(plain) - _count(plain, " \t\n\x0b\x0c\r")).cast("long"),
        "n_symbols": _count(plain, "#*$%&|<>").cast("long"), "_marks": _count(plain, "!?"),
    })
    found = found.withColumns({"n_words": F.col("_words.n_words"), "n_repeat_words": F.col("_words.n_repeat_words"), "n_dup_lines": F.col("_lines.again").cast("long")})
    per_word = lambda value: F.when(F.col("n_words") > 0, value / F.col("n_words")).otherwise(0.0)
    found = found.withColumns({
        "base_failed": (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words")),
        "symbols_per_word": per_word(F.col("n_symbols")), "repeat_share": per_word(F.col("n_repeat_words")), "marks_per_word": per_word(F.col("_marks")),
        "dup_line_share": F.when(F.col("_lines.lines") > 0, F.col("_lines.again") / F.col("_lines.lines")).otherwise(0.0), "long_words": per_word(F.col("word_chars")),
    })
    return found.drop("_words", "_lines", "_marks")


def _log_factorial(n: Column) -> Column:
    """ln n! by Stirling's series, moved up by eight so that it is exact to about 1e-12."""
    x = n.cast("double") + 9
    series = (x - 0.5) * F.log(x) - x + 0.9189385332046727 + 1 / (12 * x) - 1 / (360 * x * x * x) + 1 / (1260 * F.pow(x, 5))
    down = F.lit(0.0)
    for step in range(1, 9):
        down = down + F.log(n.cast("double") + step)
    return series - down


def binomial_tail(n: Column, k: Column, rate: float) -> Column:
    """P(X <= k) of a binomial with n trials, or a little more where k is beyond ``_TERMS``.

    Below the mean each term is at most q times the one above it, with q taken at the lowest term added: the terms left
    out are at most those of a geometric series, which is added for them, so that a cutoff is never certified too soon.
    """

    def term(i: Column) -> Column:
        ways = _log_factorial(n) - _log_factorial(i) - _log_factorial(n - i)
        return F.exp(ways + i * F.log(F.lit(rate)) + (n - i) * F.log1p(F.lit(-rate)))

    low = F.greatest(F.lit(0).cast("long"), k - _TERMS)
    q = low * (1 - rate) / ((n - low + 1) * rate)
    below = F.when(low == 0, 0.0).when(q < 1, term(low) * q / (1 - q)).otherwise(1.0)
    added = F.aggregate(F.sequence(low, k), F.lit(0.0), lambda total, i: total + term(i))
    return F.when(k >= n, F.lit(1.0)).otherwise(F.least(F.lit(1.0), added + below))


def certified_cutoffs(measured: DataFrame, labels: DataFrame, stratum: str = "lang") -> DataFrame:
    """(stratum, cutoffs): for each rule the strictest proven cutoff, null where none is."""
    good = labels.where("doc_id is not null").groupBy("doc_id").agg(F.max("quality").alias("quality")).where("quality = 1").select("doc_id")
    names = list(GRIDS)
    held = measured.where("not base_failed").join(good, "doc_id", "left_semi").withColumn("stratum", F.coalesce(F.col(stratum).cast("string"), F.lit("")))
    tests = [(name, cut) for name, grid in GRIDS.items() for cut in grid]
    rejected = [F.sum((F.col(name) > cut).cast("long")).alias(f"r{number}") for number, (name, cut) in enumerate(tests)]
    totals = held.groupBy("stratum").agg(F.count("*").alias("n"), *rejected)
    strata = totals.agg(F.count("*").alias("strata"))
    listed = F.array(*[F.struct(F.lit(name).alias("rule"), F.lit(cut).alias("cut"), F.col(f"r{number}").alias("k")) for number, (name, cut) in enumerate(tests)])
    each = totals.crossJoin(F.broadcast(strata)).select("stratum", "n", "strata", F.explode(listed).alias("test")).select("stratum", "n", "strata", "test.*")
    proven = each.where(binomial_tail(F.col("n"), F.col("k"), RISK / len(names)) <= DELTA / (len(tests) * F.col("strata")))
    return proven.groupBy("stratum").agg(*[F.min(F.when(F.col("rule") == name, F.col("cut"))).alias(f"cut_{name}") for name in names])


def risk_controlled(documents: DataFrame, labels: DataFrame, stratum: str = "lang") -> DataFrame:
    """One row per document: doc_id, the stratum, the counts and measures, base_failed and kept.

    ``labels`` (doc_id, quality 0 or 1) hold out the documents that thresholds are proven on; the higher of repeated
    labels counts, a null one none.  A null stratum is one of its own.  Rows that repeat a doc_id are judged by their own
    texts, each labelled alike.  Measures equal to a cutoff stay.  Empty tables give empty results.
    """
    columns = ["doc_id", stratum, "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", *GRIDS]
    measured = materialise(measure(documents).select(*dict.fromkeys(columns)))
    cuts = certified_cutoffs(measured, labels, stratum)
    joined = measured.withColumn("stratum", F.coalesce(F.col(stratum).cast("string"), F.lit(""))).join(cuts, "stratum", "left")
    above = F.lit(False)
    for name in GRIDS:
        above = above | F.coalesce(F.col(name) > F.col(f"cut_{name}"), F.lit(False))
    return joined.withColumn("kept", ~F.col("base_failed") & ~above)


def oracle_sql() -> str:
    """The query's rows in DuckDB."""
    tests = [(name, cut) for name, grid in GRIDS.items() for cut in grid]
    grid = ", ".join(f"('{name}', {cut})" for name, cut in tests)
    value = "CASE rule " + " ".join(f"WHEN '{name}' THEN {name}" for name in GRIDS) + " END"
    rate = RISK / len(GRIDS)
    return f"""
WITH words AS (SELECT doc_id, lang, coalesce(text, '') AS text,
    list_filter(string_split_regex(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'), lambda w: w <> '') AS w,
    list_filter(string_split(coalesce(text, ''), chr(10)), lambda l: regexp_matches(l, '[^\\x20\\x09-\\x0D]')) AS l FROM documents),
counts AS (SELECT doc_id, lang, w, len(w) AS n_words, CAST(len(array_to_string(w, '')) AS BIGINT) AS word_chars,
    CAST(len(text) - len(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
    len(text) - len(regexp_replace(text, '[!?]', '', 'g')) AS marks,
    len(l) AS n_lines, len(l) - len(list_distinct(l)) AS n_dup_lines FROM words),
windows AS (SELECT doc_id, unnest(range(1, len(w) - 1)) AS pos, w FROM counts),
named AS (SELECT doc_id, pos, [w[pos], w[pos + 1], w[pos + 2]] AS window_words FROM windows),
again AS (SELECT doc_id, pos FROM named QUALIFY count(*) OVER (PARTITION BY doc_id, window_words) > 1),
repeats AS (SELECT doc_id, count(DISTINCT pos + k) AS n FROM again, range(0, 3) AS t(k) GROUP BY doc_id),
measured AS (SELECT doc_id, coalesce(lang, '') AS stratum, n_words, word_chars, n_symbols, n_dup_lines, coalesce(n, 0) AS n_repeat_words,
    n_words < 50 OR 100 * coalesce(n, 0) > 50 * n_words AS base_failed,
    coalesce(n_symbols / nullif(n_words, 0), 0) AS symbols_per_word, coalesce(n / nullif(n_words, 0), 0) AS repeat_share,
    coalesce(n_dup_lines / nullif(n_lines, 0), 0) AS dup_line_share, coalesce(marks / nullif(n_words, 0), 0) AS marks_per_word,
    coalesce(word_chars / nullif(n_words, 0), 0) AS long_words FROM counts LEFT JOIN repeats USING (doc_id)),
good AS (SELECT doc_id FROM labels GROUP BY doc_id HAVING max(quality) = 1),
held AS (SELECT * FROM measured WHERE NOT base_failed AND doc_id IN (SELECT doc_id FROM good)),
tests AS (SELECT stratum, rule, cut, count(*) AS n, count(*) FILTER ({value} > cut) AS k
    FROM held, (VALUES {grid}) AS g(rule, cut) GROUP BY ALL),
proven AS (SELECT stratum, rule, min(cut) AS cut FROM (SELECT *,
    list_sum(list_transform(range(0, k + 1), lambda i:
      exp(lgamma(n + 1) - lgamma(i + 1) - lgamma(n - i + 1) + i * ln({rate}) + (n - i) * ln(1 - {rate})))) AS p FROM tests)
    WHERE p <= {DELTA} / ({len(tests)} * (SELECT count(DISTINCT stratum) FROM held)) GROUP BY ALL)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
    NOT base_failed AND NOT EXISTS (SELECT 1 FROM proven p WHERE p.stratum = m.stratum AND {value} > p.cut) AS kept
FROM measured m
"""
