"""Language identification and toxicity: held-out accuracy, folding, edge cases."""

import random

import numpy as np
import pytest

from shelfcast.llm import language, toxicity

SYLLABLES = {"aa": "ka lo mi nu re", "bb": "sch ung ein ver ö", "cc": "ción que ñ dad ar", "dd": "при вет мир как да"}


def sentence(name, chance, words=25):
    return " ".join("".join(chance.choice(SYLLABLES[name].split()) for _ in range(chance.randint(1, 3))) for _ in range(words))


@pytest.fixture
def languages(frame):
    chance = random.Random(1)
    rows = [(k, sentence(name, chance), name) for k in range(120) for name in SYLLABLES]
    return language.learn(frame(rows, "doc_id long, text string, lang string"))


def test_held_out_languages_and_odd_texts(frame, languages):
    chance = random.Random(2)
    rows = [(k, sentence(name, chance, 6), name) for k in range(50) for name in SYLLABLES]
    odd = [(1000, None, None), (1001, "", None), (1002, "12 !? …", None), (1003, "ka" * 100_000, None)]
    found = language.identify(frame(rows + odd, "doc_id long, text string, score string"), languages).collect()
    assert len(found) == len(rows) + 4
    right = {(text): name for _, text, name in rows}
    assert np.mean([row["lang_pred"] == right[row["text"]] for row in found if row["doc_id"] < 1000]) > 0.97
    assert all(row["lang_pred"] == "und" and row["score"] == 0 for row in found if row["doc_id"] in (1000, 1001, 1002))
    assert all(0 <= row["score"] <= 1 for row in found) and {row["lang_pred"] for row in found if row["doc_id"] == 1003} == {"aa"}


def test_nothing_to_learn_a_language_from(frame):
    empty = frame([], "doc_id long, text string, lang string")
    model = language.learn(frame([(1, None, "aa"), (2, "text", None), (3, "12", "aa")], "doc_id long, text string, lang string"))
    assert [row["lang_pred"] for row in language.identify(frame([(1, "some text")], "doc_id long, text string"), model).collect()] == ["und"]
    assert language.identify(empty, language.learn(empty)).count() == 0


def test_folding():
    given = ["1d10t! Ѕtupid $tuff the$$$ 2024 a1", "ｓｃｕｍ, cl0wn i​diot", "", "É  à\n-- b", "&&& ***"]
    assert toxicity.fold(given) == [" idiot stupid stuff the 2024 ai ", " scum clown idiot ", " ", " é à b ", " "]


def test_folding_of_long_runs_of_signs():
    given = ["b4574rd 455455in", "a45745745", "2024 45745 $$$$$ ok"]
    assert toxicity.fold(given) == [" bastard assassin ", " aastastas ", " 2024 45745 ok "]


def test_lexicon_finds_disguised_words_and_spares_exceptions(frame):
    chance = random.Random(3)
    plain = lambda: " ".join(chance.choice("alpha beta gamma delta omega river stone cloud".split()) for _ in range(30))
    rows, labels = [], []
    for k in range(600):
        toxic, text = k % 5 == 0, plain()
        if toxic:
            text += " " + chance.choice(("moronic", "scumbag")) + " " + plain()
        elif k % 24 == 1:
            text += " scumbag beetle " + plain()
        rows.append((k, text))
        labels.append((k, int(toxic)))
    lexicon = toxicity.learn(frame(rows, "doc_id long, text string"), frame(labels, "doc_id long, toxic int"), given=("moronic inferno",))
    fresh = [(1, plain() + " m0r0nic " + plain()), (2, plain()), (3, plain() + " ѕcumbаg " + plain()), (4, plain() + " scumbag beetle " + plain()), (5, plain() + " moronic inferno " + plain()), (6, None), (7, ""), (8, "alpha " * 100_000 + "moronic")]
    found = {row["doc_id"]: row["score"] for row in toxicity.score(frame([(*row, "x") for row in fresh], "doc_id long, text string, score string"), lexicon).collect()}
    assert found[1] >= 0.3 and found[3] >= 0.3
    assert all(found[k] < 0.3 for k in (2, 4, 5, 6, 7))
    assert found[6] == found[7] and 0 <= found[8] <= 1


def test_nothing_to_learn_toxicity_from(frame):
    rows = frame([(1, "a b"), (2, None)], "doc_id long, text string")
    for labels in ([], [(1, 0)], [(1, None), (None, 1)]):
        lexicon = toxicity.learn(rows, frame(labels, "doc_id long, toxic int"))
        assert all(row["score"] < 0.3 for row in toxicity.score(rows, lexicon).collect())
    assert toxicity.score(frame([], "doc_id long, text string"), lexicon).count() == 0


def dense(name, chance, letters):
    """Words of the same twelve letters, as often as the language has them: any four of them meet in a long text."""
    order = random.Random(name).sample("abcdefghijkl", 12)
    return "".join(chance.choices([*order, " "], [*(1 / (k + 1) for k in range(12)), 0.6], k=letters))


def test_very_long_texts_keep_their_language(frame):
    chance = random.Random(5)
    names = ("aa", "bb", "cc", "dd")
    model = language.learn(frame([(k, dense(name, chance, 1000), name) for k in range(60) for name in names], "doc_id long, text string, lang string"))
    best, share, _ = model.rate([dense(name, chance, letters) for letters in (3000, 1_000_000) for name in names])
    assert [model.names[k] for k in best] == [*names, *names]
    assert (abs(share[4:] - share[:4]) < 0.1).all() and (share[4:] >= 0.4).all()
    best, share, has = model.rate(["1" * 30_000 + dense("bb", chance, 9000), "", "2" * 20_000])
    assert model.names[best[0]] == "bb" and has.tolist() == [True, False, False]


def test_long_labelled_texts_and_all_languages_are_learned(frame, monkeypatch):
    monkeypatch.setattr(language, "LANGUAGES", 2)
    chance = random.Random(6)
    rows = [(k, dense(name, chance, 60_000 if name == "aa" else 1000), name) for k in range(8) for name in ("aa", "bb", "cc", "dd")]
    model = language.learn(frame(rows, "doc_id long, text string, lang string"))
    assert model.names == ["aa", "bb", "cc", "dd"]
    assert [model.names[k] for k in model.rate([dense(name, chance, 4000) for name in model.names])[0]] == model.names


def test_repeated_rows_ties_and_empty_tables(frame, languages):
    rows = [(1, "ka lo mi nu", "x"), (1, "ka lo mi nu", "x"), (2, "ka lo mi nu", "y"), (1, "другой вет", "x")]
    found = language.identify(frame(rows, "doc_id long, text string, held_out string"), languages).collect()
    assert len({(row["lang_pred"], row["score"]) for row in found if row["text"].startswith("ka")}) == 1 and len(found) == 4
    lexicon = toxicity.Lexicon({" bad": 2.0})
    scored = toxicity.score(frame([(1, "bad day", 1), (1, "bad day", 1), (2, "bad day", 2), (3, "good day", 3)], "doc_id long, text string, label int"), lexicon).collect()
    assert len({row["score"] for row in scored if row["text"] == "bad day"}) == 1 and len(scored) == 4
    for empty in (language.identify(frame([], "doc_id long, text string"), languages), toxicity.score(frame([], "doc_id long, text string"), lexicon)):
        assert empty.collect() == []
