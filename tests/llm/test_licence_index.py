"""op7's whole texts: what is a copy and what is not, written from the method: rare words by place first, key phrases last."""

import random

import pytest
from sessionloom.llm import licence_texts, licences

TEXTS = {label: (text, keys) for label, text, keys in licence_texts.TEMPLATES}
PLAIN = ["Plain words of a text that is no licence at all, with the and of in it."] * 60


def labels(spark, texts):
    rows = spark.createDataFrame(list(enumerate([*texts, *PLAIN])), "doc_id long, text string")
    found = {r.doc_id: r for r in licences.scanned(rows).collect()}
    assert all(found[len(texts) + i].labels == "" for i in range(len(PLAIN)))
    return [set(filter(None, found[i].labels.split(","))) for i in range(len(texts))], [found[i].score for i in range(len(texts))]


def held(label):
    """(words, places inside key phrases) of a licence text."""
    own = [w.decode() for w in licences.words(TEXTS[label][0].encode())]
    template = next(t for t in licences.templates() if t.label == label and t.whole and [w.decode() for w in t.words] == own)
    return own, {at + i for at, p in template.keys for i in range(len(p))}


def test_key_phrases_alone_are_no_copy_and_the_rest_without_them_is_none_either(spark):
    only, without = [], []
    for label in TEXTS:
        own, inside = held(label)
        only.append(" ".join(w if i in inside else "zzz" for i, w in enumerate(own)))
        without.append(" ".join("zzz" if i in inside else w for i, w in enumerate(own)))
    found, _ = labels(spark, only + without)
    notices = [{label for p, label in [*licence_texts.BASE.items(), *licence_texts.NOTICES.items()] if p in t} for t in only + without]
    assert found == notices  # what is left are short notices that a text happens to hold


@pytest.mark.parametrize("share", [0.0, 0.1, 0.2])
def test_copies_with_other_words_changed(spark, share):
    rng, texts = random.Random(7), []
    for label in TEXTS:
        own, inside = held(label)
        texts.append("head of the file " + " ".join(w if i in inside or rng.random() >= share else f"x{rng.randrange(99)}" for i, w in enumerate(own)) + " tail")
    found, scores = labels(spark, texts)
    assert all(label in f for label, f in zip(TEXTS, found, strict=True))
    if share == 0:
        assert max(scores) == pytest.approx(1.0) and min(scores) > 0


def test_gaps_in_key_phrases(spark):
    texts = [text.replace(" ", "  \n * ") for text, _ in TEXTS.values()]
    own, inside = held("mit")
    start = min(inside)
    texts += [" ".join([*own[: start + 2], "2024", "acme", *own[start + 2 :]]), " ".join([*own[: start + 2], "one", "two", "three", *own[start + 2 :]])]
    found, _ = labels(spark, texts)
    assert all(label in f for label, f in zip(TEXTS, found, strict=False))
    assert "mit" in found[-2] and "mit" not in found[-1]


def test_several_licences_and_copies_in_one_file(spark):
    rng = random.Random(5)
    filler = lambda n: " ".join(rng.choice(["the", "of", "software", "notice", "plain", "word", "and"]) for _ in range(n))
    every = " ".join(f"{filler(150)} {text}" for text, _ in TEXTS.values())
    mit = TEXTS["mit"][0]
    found, _ = labels(spark, [every, f"{mit} {filler(3000)} {mit}", filler(5000)])
    assert found[0] >= set(TEXTS) and found[1] == {"mit"} and found[2] == set()
    known = licences.templates()
    own = licences.words(f"{mit} {filler(500)} {mit}".encode())
    index = licences.RareTokenIndex(known, {w: 1.0 for t in known for w in t.words})
    places = index.places(" ".join(w.decode() for w in own).encode(), own)
    at = next(i for i, t in enumerate(known) if t.whole and t.label == "mit")
    assert places[at] == [0, len(own) - len(known[at].words)]


def test_parts_and_shuffled_texts_are_no_copies(spark):
    rng, texts = random.Random(2), []
    for label in TEXTS:
        own, _ = held(label)
        mixed = own[:]
        rng.shuffle(mixed)
        texts += [" ".join(mixed), " ".join(own[: len(own) // 3]), " ".join(reversed(own))]
    found, _ = labels(spark, texts)
    wholes = {label for label in TEXTS}
    notice_labels = set(licence_texts.BASE.values()) | set(licence_texts.NOTICES.values())
    assert all(not f & (wholes - notice_labels) for f in found) and sum("mit" in f for f in found[:3]) == 0
