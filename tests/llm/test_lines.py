import random

import duckdb
import pandas as pd
import pytest

import corpus_pipeline
from shelfcast.llm import lines, quality, queries


def twin(rows, sql, **tables):
    con = duckdb.connect()
    con.register("given", pd.DataFrame(rows, columns=["doc_id", "text"]).astype({"doc_id": "Int64", "text": "string"}))
    con.execute("CREATE TABLE documents AS SELECT CAST(doc_id AS BIGINT) AS doc_id, CAST(text AS VARCHAR) AS text FROM given")
    for name, values in tables.items():
        con.execute(f"CREATE TABLE {name} AS {values}")
    return con.execute(sql)


def corpus(seed, documents=60):
    """Lines of few words that are copied, edited a little, edited a lot, reordered, or new."""
    chance = random.Random(seed)
    word = lambda: f"w{int(chance.paretovariate(0.6)) % 400}"
    known = [[word() for _ in range(chance.choice((2, 5, 6, 9, 14, 30, 80)))] for _ in range(25)]
    rows = []
    for number in range(documents):
        text = []
        for _ in range(chance.randint(0, 6)):
            line = list(chance.choice(known))
            for _ in range(chance.choice((0, 0, 1, 1, 2, 3, 8))):
                line[chance.randrange(len(line))] = word()
            if chance.random() < 0.2:
                chance.shuffle(line)
            text.append(chance.choice((" ", "  ", "\t")).join(line))
        rows.append((number * 3 % 61, "\n".join(text)))
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_equals_all_pairs_of_lines(frame, seed):
    rows = corpus(seed)
    found = lines.drop_repeated_lines(frame(rows, "doc_id long, text string")).select("doc_id", "n_lines", "n_removed", "text").collect()
    expected = twin(rows, lines.oracle_sql()).fetchall()
    assert sorted(map(tuple, found)) == sorted(expected)
    assert sum(row["n_removed"] for row in found) > 20


def test_a_group_of_near_copies_leaves_one(frame):
    base = [f"word{k}" for k in range(40)]
    rows = [(k, " ".join([*base[: k % 40], f"new{k}", *base[k % 40 + 1 :]])) for k in range(200)]
    found = {row["doc_id"]: row["n_removed"] for row in lines.drop_repeated_lines(frame(rows, "doc_id long, text string")).collect()}
    assert found == {k: int(k > 0) for k in range(200)}


def test_odd_rows(frame):
    line = "one two three four five six"
    rows = [(1, None, 9), (2, "", 9), (3, line + "\n\n" + line, 9), (4, line, 9), (None, line, 9), (5, "a b\na b", 9), (6, "\x0b\x0c \t", 9), (7, "x " * 5000, 9), (4, line, 9)]
    result = lines.drop_repeated_lines(frame(rows, "doc_id long, text string, n_lines int"))
    found = sorted(map(tuple, result.select("doc_id", "text", "n_lines", "n_removed").collect()), key=str)
    assert found == sorted(
        [(1, None, 0, 0), (2, "", 1, 0), (3, line + "\n", 3, 1), (4, "", 1, 1), (4, "", 1, 1), (None, line, 1, 0), (5, "a b\na b", 2, 0), (6, "\x0b\x0c \t", 1, 0), (7, "x " * 5000, 1, 0)], key=str
    )
    assert result.columns == ["doc_id", "text", "n_lines", "n_removed"]


def test_no_documents(frame):
    assert lines.drop_repeated_lines(frame([], "doc_id long, text string")).count() == 0


def test_no_python_in_the_plan(frame):
    frames = [lines.drop_repeated_lines(frame(corpus(3, 10), "doc_id long, text string")), quality.measure(frame(corpus(3, 10), "doc_id long, text string"))]
    for found in frames:
        plan = found._jdf.queryExecution().executedPlan().toString()
        assert not any(word in plan for word in ("Python", "Pandas", "Arrow"))


def short_lines(seed, documents=40):
    """Lines of one to six words out of few, so that most of them repeat or nearly repeat another."""
    chance = random.Random(seed)
    line = lambda: " ".join(chance.choice("abcdefg") for _ in range(chance.randint(0, 6)))
    return [(number, "\n".join(line() for _ in range(chance.randint(0, 5)))) for number in range(documents)]


@pytest.mark.parametrize("rows", [short_lines(1), corpus(4)])
def test_lines_of_few_words_equal_all_pairs(frame, rows):
    found = lines.drop_repeated_lines(frame(rows, "doc_id long, text string"), least=1).select("doc_id", "n_lines", "n_removed", "text").collect()
    assert sorted(map(tuple, found)) == sorted(twin(rows, lines.oracle_sql(least=1)).fetchall())


def test_query_and_pipeline_remove_lines_of_few_words(spark, frame, tmp_path):
    texts = ["Home\nRead more\none two three four", "one two three four five\nRead more\n\nHome page", "Home\n-- x --\nRead  more"]
    rows = [(number, text, len(text)) for number, text in enumerate(texts, 1)]
    frame(rows, "doc_id long, text string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    expected = {1: rows[0][1], 2: "\nHome page", 3: "-- x --"}
    assert {row["doc_id"]: row["text"] for row in queries.op9_line_dedup(spark, str(tmp_path)).collect()} == expected
    docs = corpus_pipeline.without_repeated_lines(spark, spark.read.parquet(f"{tmp_path}/documents.parquet"), str(tmp_path))
    assert {row["doc_id"]: (row["text"], row["n_chars"]) for row in docs.collect()} == {key: (text, len(text)) for key, text in expected.items()}


@pytest.mark.parametrize("threshold", [0.45, 0.6, 0.7, 0.9])
def test_other_thresholds_equal_all_pairs(frame, threshold):
    rows = corpus(5, 30) + [(number + 100, text) for number, text in short_lines(2, 20)]
    found = lines.drop_repeated_lines(frame(rows, "doc_id long, text string"), threshold, least=1).select("doc_id", "n_lines", "n_removed", "text").collect()
    assert sorted(map(tuple, found)) == sorted(twin(rows, lines.oracle_sql(threshold, least=1)).fetchall())


def test_word_classes_add_little_to_a_plan(frame):
    assert len(lines._rarity(frame(corpus(1), "doc_id long, text string"))) < 1 << 15


def test_lines_that_share_single_words_travel_no_further(frame):
    rows = [(k, " ".join([f"shared{k % 5}", *(f"own{k}x{j}" for j in range(9))])) for k in range(100)]
    docs = frame([*rows, (100, rows[0][1] + " more")], "doc_id long, text string")
    signed = lines._signed(docs, lines._rarity(docs), 0.8).selectExpr("doc_id", "line", "n", "posexplode(grams) AS (p, gram)")
    assert {row["doc_id"] for row in lines._shared(signed, 0.8).collect()} == {0, 100}


def test_a_repeated_doc_id_with_other_text_keeps_its_matches(frame):
    base = [f"word{k}" for k in range(20)]
    rows = [(1, " ".join(base)), (2, " ".join([*base[:19], "new"])), *[(2, " ".join(f"other{j}x{k}" for k in range(20))) for j in range(5)]]
    found = lines.drop_repeated_lines(frame(rows, "doc_id long, text string")).select("doc_id", "n_removed").collect()
    assert sorted(map(tuple, found)) == [(1, 0), *[(2, 1)] * 6]
