"""Language sets: no language is left out before the penalised likelihood has judged it."""

import numpy as np

from sessionloom.llm import language


def made(seed=5, words=400):
    """A model of ten languages, nine of them akin, and a maker of texts in each."""
    rng = np.random.default_rng(seed)
    letters = np.array(list("abcdefghijklmnopqrstuvwxyz"))
    common = ["".join(rng.choice(letters, rng.integers(3, 8))) for _ in range(words)]
    lists = [common[: words * 3 // 4] + ["".join(rng.choice(letters, rng.integers(3, 8))) for _ in range(words // 4)] for _ in range(9)]
    lists.append(["".join(rng.choice(list("가나다라마바사아자차카타파하거너더러"), rng.integers(2, 5))) for _ in range(words)])
    text = lambda i, n, s: " ".join(np.random.default_rng(s).choice(lists[i], n))
    names = [f"l{i}" for i in range(10)]
    counts = np.stack([np.bincount(language.trigrams(text(i, 60_000, i)), minlength=language.FEATURES) for i in range(10)], axis=1)
    chance = (counts + 0.05) / (counts.sum(axis=0) + 0.05 * language.FEATURES)
    return language.LanguageModel(names, chance.astype(np.float32)), text


def test_small_share_and_far_language():
    model, text = made()
    tenth = text(0, 900, 100) + " " + text(9, 100, 101)
    passage = text(0, 19_700, 102) + " " + text(9, 300, 103)
    alone = text(3, 2_000, 104)
    three = " ".join(text(i, 500, 105 + i) for i in (1, 4, 9))
    got = [{n: s for n, s in x[2]} for x in model.mixtures([tenth, passage, alone, three])]
    assert set(got[0]) == {"l0", "l9"} and 0.02 < got[0]["l9"] < 0.2
    assert set(got[1]) == {"l0", "l9"} and 0 < got[1]["l9"] < 0.02
    assert set(got[2]) == {"l3"}
    assert set(got[3]) == {"l1", "l4", "l9"}


def test_shares_like_a_plain_em():
    model, text = made()
    mixed = text(0, 600, 200) + " " + text(9, 200, 201)
    found = {n: s for n, s in model.mixtures([mixed])[0][2]}
    grams = language.trigrams(mixed)
    chance = model.chance[grams][:, [model.names.index(n) for n in sorted(found)]].astype(np.float64)
    share = np.full(len(found), 1 / len(found))
    for _ in range(200):
        weight = share * chance
        share = (weight / weight.sum(axis=1, keepdims=True)).mean(axis=0)
    assert np.allclose([found[n] for n in sorted(found)], share, atol=0.01)


def test_very_many_languages(spark):
    """Beyond 256 languages trigrams share places; all languages are still learned."""
    rng = np.random.default_rng(8)
    letters = [[chr(0x4E00 + 40 * i + k) for k in range(20)] for i in range(300)]
    rows = [(i * 3 + k, "".join(rng.choice(letters[i], 120)), f"l{i:03}") for i in range(300) for k in range(2)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = language.train(docs)
    assert len(model.names) == 300 and model.chance.size <= language.TABLE
    got = language.predict(docs, model).collect()
    lang = {r[0]: r[2] for r in rows}
    assert np.mean([r.lang_pred == lang[r.doc_id] for r in got]) > 0.99
