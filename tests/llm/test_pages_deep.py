"""The chain model against enumeration, and pages with very deep nesting."""

import itertools
import math
import random
import tracemalloc

import numpy as np

from grantlens.llm import html_blocks, html_extraction
from grantlens.llm.html_extraction import ChainModel


def likelihood(scores, steps, labels):
    return sum(s for s, label in zip(scores, labels) if label) + sum(steps[a][b] for a, b in zip(labels, labels[1:]))


def test_best_labels_and_marginals_equal_enumeration(monkeypatch):
    rng = random.Random(5)
    for n in range(1, 8):
        for _ in range(20):
            scores = [rng.gauss(0, 2) for _ in range(n)]
            steps = [[rng.gauss(0, 1) for _ in range(2)] for _ in range(2)]
            model = ChainModel({}, steps)
            monkeypatch.setattr(model, "scores", lambda page, scores=scores: scores)
            every = list(itertools.product((0, 1), repeat=n))
            assert tuple(model.decode([None] * n)) == max(every, key=lambda labels: likelihood(scores, steps, labels))
            weights = {labels: math.exp(likelihood(scores, steps, labels)) for labels in every}
            total = sum(weights.values())
            chance, pairs = html_extraction.marginals(scores, np.array(steps))
            for at in range(n):
                assert math.isclose(chance[at], sum(w for labels, w in weights.items() if labels[at]) / total)
            for a, b in itertools.product((0, 1), repeat=2):
                met = sum(w * sum(pair == (a, b) for pair in zip(labels, labels[1:])) for labels, w in weights.items())
                assert math.isclose(pairs[a, b], met / total, abs_tol=1e-12)


def test_deep_nesting_needs_memory_by_length():
    letters = "abcdefghijklmnopqrstuvwxyz"
    names = ["".join(c) for c in itertools.islice(itertools.product(letters, repeat=4), 20_000)]
    page = "".join(f"<div class={n}>word {n}" for n in names)
    tracemalloc.start()
    found = html_blocks.blocks(page)
    scores = html_extraction.sums_above(found, {"n:aaaa": 1.0, "t:div": 0.5})
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert len(found) == 20_000 and set(scores) == {1.5}
    assert most < 200_000_000


def test_names_end_with_their_element():
    page = "<div class=story><p id=lead>one<p>two</div><section class='story lead'>three<div class=story>four</section>five"
    above = {b.text: set(b.above) for b in html_blocks.blocks(page)}
    assert above == {
        "one": {"t:div", "n:story", "t:p", "n:lead"},
        "two": {"t:div", "n:story", "t:p"},
        "three": {"t:section", "n:story", "n:lead"},
        "four": {"t:section", "n:story", "n:lead", "t:div"},
        "five": set(),
    }
    hidden = html_blocks.without(html_blocks.blocks(page), frozenset({"n:story"}))
    assert [set(b.above) for b in hidden] == [names - {"n:story"} for names in above.values()]
