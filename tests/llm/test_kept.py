"""A Python worker holds the caches of one operator at a time."""

import gc
import weakref

from grantlens.llm import language, word_encoder
from grantlens.llm.queries import WORD_BPE


def test_a_worker_gives_up_the_caches_of_the_operator_before():
    trees = language.ContextTrees([("x", b"a", 1), ("y", b"b", 1)], 4)
    encoder = word_encoder.encoder_for(WORD_BPE)
    ids = encoder.encode_all(["some words"])
    assert word_encoder.encoder_for(WORD_BPE) is encoder
    gone = weakref.ref(encoder)
    del encoder
    scorer = trees.scorer()
    gc.collect()
    assert gone() is None and trees.scorer() is scorer
    gone = weakref.ref(scorer)
    del scorer
    assert word_encoder.encoder_for(WORD_BPE).encode_all(["some words"]) == ids
    gc.collect()
    assert gone() is None
