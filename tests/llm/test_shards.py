import random
import zlib

import pytest

from shelfcast.llm.shards import shard_by_bytes


def check(rows, found, shards, even=None):
    assert len(found) == len(rows)
    total, held = 0, [0] * shards
    slots = [[] for _ in range(shards)]
    for row in found:
        assert row["size"] == len((row["text"] or "").encode()) + 1
        held[row["shard"]] += row["size"]
        slots[row["shard"]].append(row["slot"])
        total += row["size"]
    for own in slots:
        assert sorted(own) == list(range(len(own)))
    if even:
        assert max(held) - min(held) <= even * total / shards
    return held


def texts(count, seed=1):
    chance = random.Random(seed)
    return [f"{k} " + "x" * chance.randint(0, 300) for k in range(count)]


def test_bytes_are_nearly_equal_and_equal_texts_stay_together(frame):
    rows = [(k, text, "s") for k, text in enumerate(texts(3000))] + [(10_000 + k, "a copied text " * 3, "h") for k in range(700)]
    found = shard_by_bytes(frame(rows, "doc_id long, text string, shard string"), 8).collect()
    check(rows, found, 8, even=0.02)
    assert len({row["shard"] for row in found if row["text"].startswith("a copied")}) == 1


def test_a_group_that_no_shard_can_hold_is_cut(frame):
    rows = [(k, text) for k, text in enumerate(texts(600))] + [(10_000 + k, "hot " * 40) for k in range(3000)]
    check(rows, shard_by_bytes(frame(rows, "doc_id long, text string"), 8).collect(), 8, even=0.05)


def test_slots_stay_gapless_over_many_ranges(frame):
    rows = [(k, text) for k, text in enumerate(texts(2000))] + [(10_000 + k, "hot " * 40) for k in range(900)]
    check(rows, shard_by_bytes(frame(rows, "doc_id long, text string"), 3, rows_per_task=100).collect(), 3, even=0.05)


@pytest.mark.parametrize("rows", [[], [(1, "one")], [(None, None), (None, ""), (7, None), (7, None)], [(5, "same")] * 50])
def test_few_and_odd_rows(frame, rows):
    check(rows, shard_by_bytes(frame(rows, "doc_id long, text string"), 8).collect(), 8)


def test_the_result_is_the_same_each_time(frame):
    rows = [(k, text) for k, text in enumerate(texts(500))]
    one, two = ({row["doc_id"]: (row["shard"], row["slot"]) for row in shard_by_bytes(frame(order, "doc_id long, text string"), 8).collect()} for order in (rows, rows[::-1]))
    assert one == two and zlib.crc32(b"") == 0


def test_very_long_texts_and_clashing_columns(frame):
    long = "long text " * 300_000
    rows = [(k, text, "a", 1) for k, text in enumerate(texts(50))] + [(100, long, "b", 2), (101, long, "c", 3), (102, None, "d", 4)]
    found = shard_by_bytes(frame(rows, "doc_id long, text string, _hash string, _range int"), 4).collect()
    check(rows, found, 4)
    assert sorted((row["doc_id"], row["_hash"], row["_range"]) for row in found) == sorted((row[0], row[2], row[3]) for row in rows)
