import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from shelfcast.llm import minhash


def classes(frame, rows, schema="doc_id long, text string"):
    return sorted(((row["doc_id"], row["class_id"], row["class_size"], row["kept"]) for row in minhash.near_duplicates(frame(rows, schema)).collect()), key=str)


def brute(frame, rows):
    """Classes by comparing all pairs with the weights that the operator counts."""
    given = frame(rows, "id long, text string").withColumn("text", F.coalesce("text", F.lit(""))).withColumn("digest", F.unhex(F.md5(F.col("text").cast("binary"))))
    shares = minhash.sketch_shares(given).astype(np.float32)
    texts = [text or "" for _, text in rows]
    owner, hashes, counts = minhash.shingles(texts)
    weights = minhash._weights(hashes, counts, shares)
    own = [(hashes[owner == k], weights[owner == k]) for k in range(len(rows))]
    parent = list(range(len(rows)))

    def root(k):
        while parent[k] != k:
            k = parent[k]
        return k

    for a in range(len(rows)):
        for b in range(a):
            if len(own[a][0]) and minhash.jaccard(own[a], own[b]) >= 0.8:
                p, q = root(a), root(b)
                parent[max(p, q)] = min(p, q)
    groups = {}
    for k in range(len(rows)):
        groups.setdefault(root(k), []).append(rows[k][0])
    return sorted(((key, min(group), len(group), key == min(group)) for group in groups.values() for key in group), key=str)


def near_copies(seed):
    chance = random.Random(seed)
    word = lambda: f"w{chance.randrange(5000)}"
    passage = " ".join(word() for _ in range(60))
    rows, key = [], 0
    for _ in range(25):
        base = [word() for _ in range(chance.randint(60, 200))]
        for _ in range(chance.choice((1, 1, 2, 6))):
            text = list(base)
            for _ in range(chance.choice((0, 1, 2, 4, 9))):
                text[chance.randrange(len(text))] = word()
            rows.append((key, " ".join(text) + (" " + passage if chance.random() < 0.4 else "")))
            key += 1
    chance.shuffle(rows)
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_equals_all_pairs(frame, seed):
    rows = near_copies(seed)
    assert classes(frame, rows) == brute(frame, rows)


def test_a_large_group_of_copies_and_near_copies(frame):
    chance = random.Random(7)
    base = [f"w{chance.randrange(9000)}" for _ in range(150)]
    rows = [(k, " ".join(base)) for k in range(200)]
    for k in range(200, 500):
        text = list(base)
        text[k % 150] = f"new{k}"
        rows.append((k, " ".join(text)))
    rows += [(1000 + k, " ".join(f"w{chance.randrange(9000)}" for _ in range(80))) for k in range(20)]
    found = classes(frame, rows)
    assert {row[1] for row in found if row[0] < 500} == {0} and all(row[2] == 500 for row in found if row[0] < 500)
    assert all(row[1] == row[0] for row in found if row[0] >= 1000)


@pytest.mark.parametrize("edits", [2, 3])
def test_near_copies_of_a_third_of_all_rows_link(frame, edits):
    """A text and its copies with some words of 200 changed: at least 0.86 by plain Jaccard, in a group of any size."""
    chance = random.Random(9)
    word = lambda: f"w{chance.randrange(20_000)}"
    base = [word() for _ in range(200)]
    rows = [(k, " ".join(word() for _ in range(60))) for k in range(1, 301)] + [(0, " ".join(base))]
    for k in range(301, 450):
        text = list(base)
        for place in chance.sample(range(200), edits):
            text[place] = word()
        rows.append((k, " ".join(text)))
    found = {row[0]: row[1] for row in classes(frame, rows)}
    caught = sum(found[k] == 0 for k in range(301, 450)) / 149
    assert caught >= 0.95
    assert all(found[k] == k for k in range(1, 301))


def test_shares_count_a_group_of_copies_about_once(frame):
    """Shares written anew: of 200 rows 100 are near copies, 50 share one line and are else different."""
    chance = random.Random(3)
    word = lambda: f"w{chance.randrange(50_000)}"
    base, line = [word() for _ in range(120)], " ".join(word() for _ in range(8))
    texts = []
    for _ in range(100):
        text = list(base)
        text[chance.randrange(120)] = word()
        texts.append(" ".join(text))
    texts += [" ".join(word() for _ in range(100)) + " " + line for _ in range(50)] + [" ".join(word() for _ in range(100)) for _ in range(50)]
    given = frame(list(enumerate(texts)), "id long, text string").withColumn("digest", F.unhex(F.md5(F.col("text").cast("binary"))))
    shares = minhash.sketch_shares(given)
    share = lambda text: max(min(shares[cell] for cell in cells) for cells in zip(*minhash._cells(minhash.shingles([text])[1]), strict=True))
    assert share(" ".join(base[:5])) < 0.05
    assert 0.35 < share(" ".join(line.split()[:5])) < 0.6


def test_odd_rows(frame):
    rows = [(1, None, "a"), (2, "", "b"), (3, "...", "c"), (4, "one two", "d"), (5, "One, TWO!", "e"), (6, "one two three", "f"), (None, "one two", "g"), (7, "x " * 60_000, "h"), (8, "x " * 60_000, "i"), (4, "one two", "d")]
    found = minhash.near_duplicates(frame(rows, "doc_id long, text string, class_id string"))
    assert found.columns == ["doc_id", "class_id", "class_size", "kept"]
    assert sorted(map(tuple, found.collect()), key=str) == sorted(
        [(1, 1, 1, True), (2, 2, 1, True), (3, 3, 1, True), (4, 4, 3, True), (4, 4, 3, True), (5, 4, 3, False), (6, 6, 1, True), (None, None, 1, True), (7, 7, 2, True), (8, 7, 2, False)], key=str
    )


def test_no_documents(frame):
    assert classes(frame, []) == []


def test_samples_agree_as_often_as_the_similarity():
    """Consistent weighted sampling: two samples agree with the probability of the weighted Jaccard similarity."""
    chance = np.random.default_rng(1)
    agreed, expected = [], []
    for _ in range(60):
        hashes = np.sort(chance.integers(0, 2**63, 120).astype(np.uint64))
        left, right = chance.gamma(2.0, 1.0, 120), chance.gamma(2.0, 1.0, 120)
        right[:80] = left[:80]
        owner = np.repeat([0, 1], 120)
        samples = minhash.signatures(owner, np.concatenate((hashes, hashes)), np.concatenate((left, right)), 2)
        agreed.append((samples[0] == samples[1]).mean())
        expected.append(np.minimum(left, right).sum() / np.maximum(left, right).sum())
    assert np.mean(agreed) == pytest.approx(np.mean(expected), abs=0.02)


def test_sketches_never_rule_out_a_link():
    """The bound from parity sketches is never below the weighted Jaccard similarity, and rules out most distant pairs."""
    chance = np.random.default_rng(4)
    ruled_out = 0
    for trial in range(200):
        pool = np.sort(chance.integers(0, 2**63, 300).astype(np.uint64))
        rarity = chance.choice(np.log1p(1 / np.clip(chance.random(300), minhash.RARE, 1)), 300)
        sides = []
        for _ in range(2):
            held = np.flatnonzero(chance.random(300) < (0.95 if trial % 2 else 0.6))
            counts = chance.integers(1, 3, len(held)) if trial % 3 == 0 else np.ones(len(held), dtype=np.int64)
            weights = rarity[held] * counts
            sketch = minhash.sketches(np.zeros(len(held), dtype=np.int64), pool[held], counts, weights, 1)
            sides.append((pool[held], weights, sketch, np.array([weights.sum()])))
        similar = minhash.jaccard(sides[0][:2], sides[1][:2])
        fits = minhash.may_link((sides[0][2], sides[0][3]), (sides[1][2], sides[1][3]), 0.8)[0, 0]
        assert fits or similar < 0.8
        ruled_out += not fits
    assert ruled_out > 80
