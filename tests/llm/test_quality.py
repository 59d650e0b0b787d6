import math
import random

import duckdb
import pytest
from pyspark.sql import functions as F

from shelfcast.llm import quality


def reference(text):
    """The base counts, word by word."""
    words = [word for word in __import__("re").split(r"[\x20\x09-\x0D]+", text or "") if word]
    again, seen = set(), {}
    for at in range(len(words) - 2):
        seen.setdefault(tuple(words[at : at + 3]), []).append(at)
    for places in seen.values():
        if len(places) > 1:
            again.update(at + k for at in places for k in range(3))
    held, dup = set(), 0
    for line in (text or "").split("\n"):
        if any(char not in " \t\n\x0b\x0c\r" for char in line):
            dup += line in held
            held.add(line)
    return len(words), sum(map(len, words)), sum((text or "").count(sign) for sign in "#*$%&|<>"), dup, len(again)


def test_counts_of_odd_texts(frame):
    chance = random.Random(3)
    texts = [None, "", " \n\t", "a", "a b", "a b c", "a a a a", "x y z x y z", "é ß 你好 #$\n\n#$\n#$", "the cat " * 3000, "a\x0bb\x0cc\r\nd"]
    texts += [chance.choice((" ", "\n")).join(chance.choice("abc|*\xa0") for _ in range(chance.randint(0, 60))) for _ in range(60)]
    rows = [(number, text, 5) for number, text in enumerate(texts)]
    found = quality.measure(frame(rows, "doc_id long, text string, n_words int")).collect()
    for row in found:
        assert (row["n_words"], row["word_chars"], row["n_symbols"], row["n_dup_lines"], row["n_repeat_words"]) == reference(texts[row["doc_id"]])
        assert row["base_failed"] == (row["n_words"] < 50 or 100 * row["n_repeat_words"] > 50 * row["n_words"])


@pytest.mark.parametrize(("n", "k", "rate"), [(10, 0, 0.1), (10, 10, 0.1), (500, 3, 0.01), (20_000, 40, 0.004), (20_000, 90, 0.004)])
def test_binomial_tail_is_exact(spark, n, k, rate):
    exact = math.fsum(math.exp(math.lgamma(n + 1) - math.lgamma(i + 1) - math.lgamma(n - i + 1) + i * math.log(rate) + (n - i) * math.log1p(-rate)) for i in range(k + 1))
    found = spark.range(1).select(quality.binomial_tail(F.lit(n).cast("long"), F.lit(k).cast("long"), rate)).first()[0]
    assert found == pytest.approx(exact, rel=1e-8)


def test_binomial_tail_of_very_many_trials_is_never_too_small(spark):
    n, rate = 500_000_000, 0.004
    for k in (1_990_000, 1_995_000):  # about 7 and 3.5 deviations below the mean, thousands of terms each
        log = lambda i: math.lgamma(n + 1) - math.lgamma(i + 1) - math.lgamma(n - i + 1) + i * math.log(rate) + (n - i) * math.log1p(-rate)
        exact, term, i = 0.0, math.exp(log(k)), k
        while term > 1e-30:  # by the ratio of neighbours
            exact += term
            term *= i * (1 - rate) / ((n - i + 1) * rate)
            i -= 1
        found = spark.range(1).select(quality.binomial_tail(F.lit(n).cast("long"), F.lit(k).cast("long"), rate)).first()[0]
        assert exact * (1 - 1e-5) <= found <= exact * 1.01 + 1e-12


def marked(count, bad):
    """Good documents of plain words, bad ones with a sign behind every word; a few good ones have signs too."""
    chance = random.Random(8)
    word = lambda: "".join(chance.choice("abcdefghij") for _ in range(5))
    rows, labels = [], []
    for number in range(count):
        is_bad = number % bad == 0
        words = [word() + ("#" if is_bad else "") for _ in range(60)]
        rows.append((number, " ".join(words), "en" if number % 3 else None))
        labels.append((number, int(not is_bad)))
    return rows, labels


def test_cutoffs_are_proven_and_reject_the_bad(frame):
    rows, labels = marked(9000, 10)
    result = quality.risk_controlled(frame(rows, "doc_id long, text string, lang string"), frame(labels, "doc_id long, quality int"))
    kept = {row["doc_id"]: row["kept"] for row in result.collect()}
    assert sum(kept[number] for number, good in labels if not good) < 100
    assert sum(not kept[number] for number, good in labels if good) <= 0.02 * 9000


def test_too_few_labels_prove_nothing(frame):
    rows, labels = marked(60, 4)
    for given in (labels, [], [(1, None), (None, 1)]):
        result = quality.risk_controlled(frame(rows, "doc_id long, text string, lang string"), frame(given, "doc_id long, quality int"))
        assert all(row["kept"] for row in result.collect())


def test_no_documents(frame):
    empty = frame([], "doc_id long, text string, lang string")
    assert quality.risk_controlled(empty, frame([(1, 1)], "doc_id long, quality int")).count() == 0


def test_equals_the_sql_twin(frame):
    rows, labels = marked(2500, 9)
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR, lang VARCHAR); CREATE TABLE labels (doc_id BIGINT, quality INTEGER)")
    con.executemany("INSERT INTO documents VALUES (?, ?, ?)", [(a, b + "! " * (a % 7), c) for a, b, c in rows])
    con.executemany("INSERT INTO labels VALUES (?, ?)", labels)
    given = con.execute("SELECT * FROM documents").fetchall()
    result = quality.risk_controlled(frame(given, "doc_id long, text string, lang string"), frame(labels, "doc_id long, quality int"))
    found = sorted(map(tuple, result.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept").collect()))
    assert found == sorted(con.execute(quality.oracle_sql()).fetchall())
