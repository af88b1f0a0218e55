"""Code lengths against a plain coder, whole contexts under a bound, and scores of what was not learned."""

import math
import random
from collections import Counter

import pytest

from grantlens.llm import language

TEXTS = {
    "en": ["the cat sat on the mat and looked at the dog", "a dog and a cat are friends of the house", "over there the river runs"],
    "es": ["el gato y el perro son amigos de la casa", "la casa del gato está en la montaña", "el niño corre por la calle"],
}


@pytest.fixture(scope="module")
def labelled(spark):
    rows = [(n, lang, text) for lang, texts in TEXTS.items() for n, text in enumerate(texts * 3)]
    return spark.createDataFrame(rows, "doc_id long, lang string, text string")


def plain_bits(texts, word, order):
    """The code length of a word, counting anew for every byte."""
    seen = [b" " + w.encode() + b" " for t in texts for w in language.LETTERS.findall(t.lower())]
    coded, bits = b" " + word.encode() + b" ", 0.0
    for at in range(1, len(coded)):
        out = set()
        for k in range(min(order, at), -1, -1):
            counts = Counter(
                w[i] for w in seen for i in range(max(1, k), len(w)) if w[i - k : i] == coded[at - k : at] and w[i] not in out
            )
            if not counts:
                continue
            total = sum(counts.values()) + len(counts)
            if coded[at] in counts:
                bits -= math.log2(counts[coded[at]] / total)
                break
            bits -= math.log2(len(counts) / total)
            out |= set(counts)
        else:
            bits -= math.log2(1 / max(1, 256 - len(out)))
    return bits


def test_code_lengths_equal_a_plain_coder(labelled):
    trees = language.learn_trees(labelled, order=3)
    for word in ("cat", "casa", "montaña", "zzz", "привет", "thecasa", "x"):
        got = trees.word(word)
        expected = [plain_bits(TEXTS[lang] * 3, word, 3) for lang in trees.languages]
        assert got[:-1] == pytest.approx(expected)


def test_bounded_trees_keep_whole_contexts(labelled):
    whole, small = language.learn_trees(labelled), language.learn_trees(labelled, grams_per_language=60)
    for full, cut in zip(whole.trees, small.trees):
        assert 0 < sum(map(len, cut.values())) <= 60 and len(cut) < len(full)
        assert all(full[context] == seen for context, seen in cut.items())
        assert all(context[1:] in cut for context in cut if context)
    for context in (b"", b"t", b"zz"):
        assert sum(2 ** -small._bits(small.trees[0], context + bytes([s])) for s in range(256)) == pytest.approx(1)


def test_score_tells_what_was_not_learned(spark, labelled):
    trees = language.learn_trees(labelled)
    rng = random.Random(2)
    noise = " ".join("".join(rng.choice("qxzjkwvfgh") for _ in range(7)) for _ in range(30))
    rows = [(1, "the dog sat on the house"), (2, "el perro corre por la casa"), (3, "привет мир как дела"), (4, noise), (5, "猫坐在垫子上")]
    found = language.predict_language(spark.createDataFrame(rows, "doc_id long, text string"), trees)
    got = {r.doc_id: (r.lang_pred, r.lang_score) for r in found.collect()}
    assert got[1][0] == "en" and got[1][1] > 0.9 and got[2][0] == "es" and got[2][1] > 0.9
    assert all(got[n][1] < 0.01 and got[n][0] in ("en", "es") for n in (3, 4, 5))
