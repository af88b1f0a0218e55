"""Caches that keep what comes again, words learned many at once, and components that end on stars."""

import random
import string

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

from grantlens.llm import alignment, components, language, word_encoder

WORD_BPE = public_tokenizers.path("word_bpe_49k.json")


def _texts(seed, rows=60, words=40):
    rng = random.Random(seed)
    signs = string.ascii_letters + "äßéñ'.,!?$&%-_0123456789́İﬁ中я"
    made = ["".join(rng.choices(signs, k=rng.randint(1, 12))) for _ in range(300)]
    made += [w + m for w in ("house", "Straße", "İ", "x") for m in ("", "$$$", "...", "'s", ",'", "!?", "<|endoftext|>", "_")]
    gap = lambda: rng.choice([" ", " ", " ", "  ", "\n", "\t", "  "])
    return ["".join(w + gap() for w in rng.choices(made, k=rng.randint(1, words))) for _ in range(rows)] + [None, "", " "]


def test_word_encoder_gives_the_tokenizers_ids_through_a_cache_that_shrinks():
    texts = _texts(1)
    tokenizer = Tokenizer.from_file(WORD_BPE)
    expected = [np.array(tokenizer.encode(t or "", add_special_tokens=False).ids, "<u4").tobytes() for t in texts]
    encoder, small = word_encoder.WordEncoder(WORD_BPE), word_encoder.WordEncoder(WORD_BPE, most_words=40, longest=8)
    assert encoder.encode_all(texts) == expected
    for _ in range(2):
        assert [encoder.encode_all([t])[0] for t in texts] == expected
        assert [small.encode_all([t])[0] for t in texts] == expected


def test_word_encoder_keeps_the_words_that_came_again():
    encoder = word_encoder.WordEncoder(WORD_BPE, most_words=20)
    encoder.encode_all(["common " * 5])
    encoder.encode_all([" ".join(f"once{n}" for n in range(30))])
    encoder.encode_all(["another"])
    assert b"common" in encoder.known and b"once7" not in encoder.known


def test_words_learned_together_have_the_bits_of_each_alone():
    counts = {}
    for lang, text in (("x", "some words of one language"), ("y", "einige wörter der anderen sprache")):
        for word in text.split():
            for gram in language.grams(word, 4):
                counts[lang, gram] = counts.get((lang, gram), 0) + 1
    for order in (2, 4, 7):
        trees = language.ContextTrees([(l, g, n) for (l, g), n in counts.items() if len(g) <= order + 1], order)
        words = ["some", "wörter", "s", "zzz", "sprachen" * 9, "中я", "language"]
        for _ in range(2):
            got = trees.words(words)
            for word, row in zip(words, got):
                alone = trees.word(word)
                assert row[:-1].tolist() == alone[:-1] and abs(row[-1] - alone[-1]) < 1e-9


def test_scores_do_not_change_with_what_is_kept():
    rows = [(lang, g, 1) for lang, w in (("x", "house"), ("y", "straße")) for g in dict.fromkeys(language.grams(w, 4))]
    texts = _texts(2)
    whole, small = (language.Scorer(language.ContextTrees(rows, 4), most) for most in (10_000, 30))
    assert list(whole.predict_all(language.pa.array(texts), 100)) == [small.predict(t) for t in texts]
    assert len(small.known) < len(whole.known)


def test_pieces_are_looked_up_once_for_all_texts(monkeypatch):
    files = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
    texts = _texts(3)
    together = alignment.Pieces(alignment.ByteTokens(files[0]), alignment.PieceTokens(files[1]))
    alone = alignment.Pieces(together.first, together.second)
    calls = []
    monkeypatch.setattr(alignment.np, "bincount", lambda x, **k: calls.append(1) or np.add.reduce(np.eye(k["minlength"], dtype=int)[x], axis=0))
    got = together.describe(texts)
    assert len(calls) == 1
    for a, text in zip(got, texts, strict=True):
        b = alone.describe([text])[0]
        assert a[1] == b[1] and all(np.array_equal(a[k], b[k]) for k in (0, 2, 3))


def test_components_stop_at_stars(spark, monkeypatch):
    stored = []
    keep = components.written
    monkeypatch.setattr(components, "written", lambda frame, name: stored.append(1) or keep(frame, name))
    found = components.components(spark.createDataFrame([(1, 2), (1, 3), (5, 4)], "a long, b long"))
    assert {tuple(r) for r in found.collect()} == {(1, 1), (2, 1), (3, 1), (4, 4), (5, 4)}
    assert len(stored) == 1
    chain = [(n, n + 1) for n in range(20)] + [(30, 30), (None, 3)]
    found = components.components(spark.createDataFrame(chain, "a long, b long"))
    assert {tuple(r) for r in found.collect()} == {(n, 0) for n in range(21)}
    assert components.components(spark.createDataFrame([], "a long, b long")).count() == 0
