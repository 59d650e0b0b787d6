import hashlib
import heapq
import random
import zlib

import duckdb
import pytest

from shelfcast.llm import conversations, queries
from shelfcast.llm.grammar import START, TAIL, Turn, best_edits, chain

BLANKS = " \t\n\v\f\r"


def cheapest(turns):
    """Least cost and ASCII-least audit by a search over (turns done, last initial given)."""
    heap, done = [(0, "", 0, "")], set()
    while heap:
        cost, audit, at, last = heapq.heappop(heap)
        if at == len(turns) and last in ("", "a"):
            return cost, audit
        if (at, last) in done:
            continue
        done.add((at, last))
        wanted = "a" if last == "u" else "u"
        heapq.heappush(heap, (cost + 2, audit + "I", at, wanted))
        if at < len(turns):
            initial, gone, truncated = turns[at]
            heapq.heappush(heap, (cost + 3, audit + "D", at + 1, last))
            if not gone:
                if initial == wanted or (initial == "s" and last == ""):
                    heapq.heappush(heap, (cost + truncated, audit + "K", at + 1, initial))
                heapq.heappush(heap, (cost + 2 + truncated, audit + "R", at + 1, wanted))


def some_turns(chance, most=12):
    letters = chance.choice(["ua", "uas", "uasx", "uuua", "s", "x"])
    return [Turn(chance.choice(letters), chance.random() < 0.15, chance.random() < 0.3) for _ in range(chance.randint(0, most))]


def test_edits_are_the_cheapest_and_least():
    chance = random.Random(1)
    for _ in range(1500):
        turns = some_turns(chance)
        assert min((cost + 2 * len(TAIL[to]), edits + TAIL[to]) for to, (cost, edits) in best_edits(turns, START).items()) == cheapest(turns)


def test_segments_chain_to_the_same_edits():
    chance = random.Random(2)
    for _ in range(600):
        turns, cut = some_turns(chance), chance.randint(1, 4)
        ways = [{state: best_edits(turns[k : k + cut], state) for state in range(4)} for k in range(0, len(turns), cut)]
        ranked = [{state: {to: (found[to][0], rank) for rank, to in enumerate(sorted(found, key=lambda to: found[to][1]))} for state, found in way.items()} for way in ways]
        path = chain(ranked)
        audit = "".join(way[state][to][1] for way, (state, to) in zip(ways, path, strict=True)) + TAIL[path[-1][1] if path else START]
        assert audit == cheapest(turns)[1]


def expected(rows):
    """The summary of one conversation's rows (turn, role, text) by plain Python."""
    rows = sorted(((t, r if r is not None else " ", x if x is not None else " ") for t, r, x in rows), key=lambda row: (row[0] is not None, row[0] or 0, row[1].encode(), row[2].encode()))
    seen, faults = set(), []
    for _, role, text in rows:
        core = text.rstrip(BLANKS)
        faults.append("blank" if not core else "duplicate" if (role, text) in seen else None if core[-1] in ".!?" else "truncated")
        seen.add((role, text))
    cost, audit = cheapest([(role[:1], fault in ("blank", "duplicate"), fault == "truncated") for (_, role, _), fault in zip(rows, faults, strict=True)])
    repaired, at, last = [], 0, ""
    for edit in audit:
        wanted = "assistant" if last == "u" else "user"
        role, text = (wanted, "") if edit == "I" else rows[at][1:]
        at += edit != "I"
        if edit != "D":
            repaired.append(f"{wanted if edit == 'R' else role}:{text}")
            last = repaired[-1][0]
    known = [turn for turn, _, _ in rows if turn is not None]
    return (
        max(known) - min(known) + 1 - len(set(known)) if known else 0,
        *(faults.count(fault) for fault in ("blank", "duplicate", "truncated")),
        sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:], strict=False)),
        cost, audit, hashlib.sha256("\n".join(repaired).encode()).hexdigest(),
    )


def check(frame, rows, schema="conv_id long, turn long, role string, text string"):
    found = conversations.summarise(conversations.repair(frame(rows, schema))).collect()
    groups: dict = {}
    for key, *row in (row[:4] for row in rows):
        groups.setdefault(key, []).append(row)
    assert {row[0]: tuple(row)[1:] for row in found} == {key: expected(group) for key, group in groups.items()}
    assert len(found) == len(groups)


def random_rows(chance, conversations_, most):
    texts = ["Yes.", "No!", "cut off", "", " \n", "Why?", None, "Fine. \t", " "]
    return [
        (c, chance.choice([t, t, t, None]), chance.choice(["user", "assistant", "user", "assistant", "system", "tool", None]), chance.choice(texts) if chance.random() < 0.5 else f"t{chance.randint(0, 9)}.")
        for c in range(conversations_)
        for t in range(chance.randint(1, most))
    ]


def test_equals_brute_force(frame):
    check(frame, random_rows(random.Random(3), 120, 9))


def test_long_conversations_are_aligned_in_segments(frame, monkeypatch):
    rows = random_rows(random.Random(4), 12, 60) + [(99, t, "user" if t % 2 else "assistant", f"{t // 5}.") for t in range(300)]
    monkeypatch.setattr(conversations, "SEGMENT", 7)
    check(frame, rows)


def test_one_conversation_over_many_partitions(spark, frame):
    rows = [(5, t, "user" if t % 3 else "assistant", f"{t % 40} text{'.' if t % 7 else ''}") for t in range(900)] + [(6, 0, "user", "Hi.")]
    check(lambda data, schema: frame(data, schema).repartition(11), rows)


def test_nulls_repeats_long_texts_and_clashing_columns(frame):
    long = "word " * 200_000
    rows = [
        (None, None, None, None, "x", 1), (None, 2, "user", "Hi.", "x", 1), (None, 2, "user", "Hi.", "y", 2), (1, 0, "", "A.", "x", 1), (1, 1, "assistant", long, "x", 1),
        (2, None, "system", "", "x", 1), (2, None, "system", "B.", "x", 1), (3, 4, "user", "Same.", "x", 1), (3, 4, "user", "Same.", "x", 1), (3, 4, "assistant", "Same.", "x", 1),
    ]
    check(frame, rows, "conv_id long, turn long, role string, text string, edit string, segment long")


@pytest.mark.parametrize("schema", ["conv_id long, turn long, role string, text string", "conv_id string, turn int, role string, text string"])
def test_no_turns(frame, schema):
    assert conversations.summarise(conversations.repair(frame([], schema))).collect() == []


def damaged(row):
    key, turn, role, text = (" " if value is None else value for value in row)
    role, text = str(role), str(text)
    kind = zlib.crc32(f"{key}:{turn}".encode()) % 20
    if kind == 1:
        text = ""
    elif kind == 2:
        text = "".join(c for c in text if c not in ".!?")
    elif kind == 4:
        role = "user"
    return [(row[1], role, text)] * {0: 0, 3: 2}.get(kind, 1)


def test_query_equals_brute_force(spark, tmp_path):
    source = spark.read.parquet("/root/testdata/sf0.001/conversations.parquet")
    extra = spark.createDataFrame([(None, None, None, None), (700, None, "user", "Hi."), (700, None, None, "Hi."), (701, 3, "system", None)], source.schema)
    source.unionByName(extra).write.parquet(f"{tmp_path}/conversations.parquet")
    groups: dict = {}
    for row in source.unionByName(extra).collect():
        groups.setdefault(row["conv_id"], []).extend(damaged(tuple(row)))
    result = queries.op11_conversations(spark, str(tmp_path))
    found = {row[0]: tuple(row)[1:] for row in result.collect()}
    assert found == {key: expected(rows) for key, rows in groups.items()}
    sql = duckdb.connect()
    sql.sql(f"CREATE VIEW conversations AS SELECT * FROM '{tmp_path}/conversations.parquet/*.parquet'")
    assert {row[0]: row[1:] for row in sql.sql(conversations.oracle_sql()).project(", ".join(result.columns)).fetchall()} == found
