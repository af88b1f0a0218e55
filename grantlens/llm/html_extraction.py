"""Main text of pages by a linear-chain conditional random field over DOM leaf blocks.

Each block is main text or not. What its ancestors are called and what its text looks like give it a score; how
main text follows other text gives a score to each pair of neighbours. The weights are trained on labelled
pages by the likelihood of their labels, and a page's best labels are found by Viterbi's algorithm.

Labelled pages are of two kinds. Pages of the corpus that mark their article (<article>, <main>) label
their own blocks; of these a bounded number is used, half of them with the mark hidden from the features, so that
the rest must be learned. Layouts made here by rule, filled with blocks of such pages, add what the
corpus may not have: side columns, notices, forms and reader comments under many names.
"""

import math
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from grantlens.llm.html_blocks import Above, Block, blocks, levels, sums_above, without

MARKS = frozenset(("t:article", "t:main", "n:article", "n:main"))
#: Words in names and tags that stand for a part which is no article, wherever it is.
OTHER_PARTS = {
    "t:nav", "t:footer", "t:aside", "t:form", "t:header", "t:dialog", "t:menu",
    "n:nav", "n:footer", "n:sidebar", "n:comments", "n:comment", "n:ad", "n:ads", "n:cookie", "n:related", "n:newsletter",
}


def block_features(page: list[Block]) -> list[list[str]]:
    """Names of what is true of each block; every name has one weight."""
    found = []
    longest = max((len(b.text) for b in page), default=0)
    for at, block in enumerate(page):
        n = len(block.text)
        words = block.text.count(" ") + 1
        share = block.linked / n
        features = [
            f"size:{min(9, n.bit_length())}",
            f"words:{min(7, words.bit_length())}",
            f"links:{0 if share == 0 else 1 if share < 0.3 else 2 if share < 0.8 else 3}",
            f"tag:{block.tag}",
            f"share:{min(4, 5 * n // max(1, longest))}",
            f"place:{min(3, at)}" if at < len(page) / 2 else f"fromend:{min(3, len(page) - 1 - at)}",
            f"ends:{block.text[-1] in '.!?:;…”\"'}",
        ]
        if "©" in block.text or "|" in block.text or "·" in block.text:
            features.append("sign")
        if block.text[0].isupper():
            features.append("capital")
        found.append(features)
    return found


class ChainModel:
    """A chain of two labels: other text 0, main text 1. ``weights`` speak for 1 against 0."""

    def __init__(self, weights: dict[str, float], steps: list[list[float]]):
        self.weights, self.steps = weights, steps

    def scores(self, page: list[Block]) -> list[float]:
        weight = self.weights.get
        base = weight("", 0.0)
        return [
            base + above + sum([weight(f, 0.0) for f in features])
            for above, features in zip(sums_above(page, self.weights), block_features(page))
        ]

    def decode(self, page: list[Block]) -> list[int]:
        """The likeliest labels of the whole page; of equals, other text."""
        (aa, ab), (ba, bb) = self.steps
        low, high, came = 0.0, 0.0, []
        for at, score in enumerate(self.scores(page)):
            if at == 0:
                came.append((0, 0))
                low, high = 0.0, score
                continue
            from_low = (low + aa, high + ba)
            from_high = (low + ab, high + bb)
            came.append((int(from_low[1] > from_low[0]), int(from_high[1] > from_high[0])))
            low, high = max(from_low), max(from_high) + score
        label, labels = int(high > low), []
        for step in reversed(came):
            labels.append(label)
            label = step[label]
        return labels[::-1]

    def extract(self, page: str | None) -> str:
        found = blocks(page)
        return "\n".join(b.text for b, label in zip(found, self.decode(found)) if label)


def train_chain(pages: list[tuple[list[Block], list[int]]], rounds: int = 30, rate: float = 0.3, ridge: float = 0.02, seed: int = 3) -> ChainModel:
    """Weights that maximise the likelihood of the labels, by gradient steps with per-weight rates (Adagrad)."""
    names: dict[str, int] = {"": 0}
    coded = []
    for page, labels in pages:
        if page:
            coded.append((*_numbered(page, names), labels))
    weights, steps = np.zeros(len(names)), np.zeros((2, 2))
    weight_sums, step_sums = np.full(len(names), 1e-6), np.full((2, 2), 1e-6)
    order = random.Random(seed)
    for _ in range(rounds):
        order.shuffle(coded)
        for flat, owner, parents, places, labels in coded:
            # Blocks come first among the owners of names, then the elements above them, each after its parent.
            sums = np.bincount(owner, weights[flat], minlength=len(places) + len(parents))
            above = sums[len(places) :].tolist()
            for at, parent in enumerate(parents):
                if parent >= 0:
                    above[at] += above[parent]
            chance, pairs = marginals([s + above[at] for s, at in zip(sums.tolist(), places)], steps)
            wrong = np.asarray(labels) - chance
            below = np.bincount(places, wrong, minlength=len(parents)).tolist()
            for at in range(len(parents) - 1, -1, -1):
                if parents[at] >= 0:
                    below[parents[at]] += below[at]
            change = np.bincount(flat, np.concatenate([wrong, below])[owner], minlength=len(names)) - ridge * weights / len(coded)
            weight_sums += change**2
            weights += rate * change / np.sqrt(weight_sums)
            seen = np.zeros((2, 2))
            for a, b in zip(labels, labels[1:]):
                seen[a, b] += 1
            change = seen - pairs - ridge * steps / len(coded)
            step_sums += change**2
            steps += rate * change / np.sqrt(step_sums)
    return ChainModel({n: float(weights[i]) for n, i in names.items()}, steps.tolist())


def _numbered(page: list[Block], names: dict[str, int]):
    """(numbers of names, what each belongs to, parents of the elements, each block's element); new names get a number."""
    order, parents, places = levels(page)
    rows = [["", *own] for own in block_features(page)] + [sorted(a.new) for a in order]
    flat = np.fromiter((names.setdefault(f, len(names)) for row in rows for f in row), dtype=np.int64)
    return flat, np.repeat(np.arange(len(rows)), [len(r) for r in rows]), parents, places


def marginals(scores: list[float], steps) -> tuple[np.ndarray, np.ndarray]:
    """(chance of label 1 at each block, expected number of each step), by the forward-backward algorithm."""
    step = np.exp(steps - np.max(steps)).tolist()
    (aa, ab), (ba, bb) = step
    shaped = [(1.0, math.exp(s)) if s < 0 else (math.exp(-s), 1.0) for s in scores]
    forward = []
    low, high = shaped[0]
    for at, (x, y) in enumerate(shaped):
        if at:
            low, high = (low * aa + high * ba) * x, (low * ab + high * bb) * y
        total = low + high
        low, high = low / total, high / total
        forward.append((low, high))
    chance, pairs = np.zeros(len(scores)), np.zeros((2, 2))
    later = (1.0, 1.0)
    for at in range(len(scores) - 1, -1, -1):
        low, high = forward[at][0] * later[0], forward[at][1] * later[1]
        chance[at] = high / (low + high)
        if at:
            x, y = shaped[at][0] * later[0], shaped[at][1] * later[1]
            before = forward[at - 1]
            both = np.array([[before[0] * aa * x, before[0] * ab * y], [before[1] * ba * x, before[1] * bb * y]])
            pairs += both / both.sum()
            later = (aa * x + ab * y, ba * x + bb * y)
            total = later[0] + later[1]
            later = (later[0] / total, later[1] / total)
    return chance, pairs


def self_labelled(page: list[Block]) -> list[int] | None:
    """Labels of a page that marks its article; None for other pages."""
    marked = sums_above(page, {"t:article": 1})
    if not any(marked):
        marked = sums_above(page, {"t:main": 1})
    other = sums_above(page, dict.fromkeys(OTHER_PARTS, 1))
    labels = [int(m > 0 and not o) for m, o in zip(marked, other)]
    return labels if any(labels) else None


#: Names under which layouts of the training pages put their parts. Fixed values of this module.
ARTICLE_NAMES = ["content", "post", "entry content", "article body", "story", "post body", "main text", "page content"]
OTHER_NAMES = {
    "menu": ["nav", "menu", "navbar", "main menu", "navigation", "breadcrumb", "topnav", "links"],
    "header": ["header", "masthead", "site header", "banner", "logo", "top"],
    "footer": ["footer", "site footer", "copyright", "bottom", "legal", "foot"],
    "side": ["sidebar", "side", "widget", "related", "recommended", "popular", "rail", "secondary", "aside"],
    "notice": ["cookie notice", "consent", "notice", "alert", "cookie banner", "message", "gdpr", "popup", "modal"],
    "advert": ["ad", "ads", "advert", "sponsored", "promo", "advertisement", "promotion", "banner ad"],
    "form": ["form", "search", "login", "newsletter", "subscribe", "signup", "contact"],
    "comment": ["comments", "comment", "replies", "responses", "discussion", "reply", "comment list", "disqus"],
    "share": ["share", "social", "meta", "byline", "tags", "author", "pagination", "pager"],
}
PART_TAGS = {
    "menu": ["nav", "div", "ul"], "header": ["header", "div"], "footer": ["footer", "div"], "side": ["aside", "div", "section"],
    "notice": ["div", "section", "dialog"], "advert": ["div", "aside", "ins"], "form": ["form"], "comment": ["div", "section", "ol"],
    "share": ["div", "ul", "p"],
}


def made_page(paragraphs: list[str], phrases: list[str], rng: random.Random) -> list[tuple[Block, int]]:
    """A labelled page: article paragraphs, and other parts filled with short phrases or with paragraphs."""
    page: list[tuple[Block, int]] = []
    outer = Above().under(["t:html", "t:body"])
    if rng.random() < 0.5:
        outer = outer.under(["t:div", f"n:{rng.choice(['wrapper', 'page', 'container', 'site', 'layout'])}"])

    def part(kind: str, above: Above):
        tag = rng.choice(PART_TAGS[kind])
        inside = above.under([f"t:{tag}"])
        if rng.random() < (0.3 if tag in ("nav", "header", "footer", "aside", "form") else 1.0):
            inside = inside.under([f"n:{w}" for w in rng.choice(OTHER_NAMES[kind]).split()])
        linked = {"menu": 1.0, "side": 0.7, "share": 0.6, "footer": 0.3, "header": 0.4}.get(kind, 0.05)
        for _ in range(rng.randint(1, {"menu": 7, "side": 5, "comment": 5}.get(kind, 2))):
            long = rng.random() < {"comment": 0.7, "side": 0.3, "notice": 0.3, "advert": 0.3}.get(kind, 0.1)
            text = rng.choice(paragraphs if long else phrases)
            own = rng.choice(["li", "p", "div"]) if kind in ("menu", "side", "comment") else rng.choice(["p", "div", tag])
            if kind == "footer" and rng.random() < 0.5:
                text = f"© {text}"
            page.append((Block(text, inside.under([f"t:{own}"]), own, len(text) if rng.random() < linked else 0), 0))

    for kind in ("notice", "header", "menu", "advert", "side", "share"):
        if rng.random() < 0.5:
            part(kind, outer)
    tag = rng.choice(["article", "main", "div", "div", "section"])
    inside = outer.under([f"t:{tag}"])
    if tag in ("div", "section"):
        inside = inside.under([f"n:{w}" for w in rng.choice(ARTICLE_NAMES).split()])
    if rng.random() < 0.8:
        page.append((Block(rng.choice(phrases), inside.under(["t:h1"]), "h1", 0), 1))
    for _ in range(rng.randint(1, 12)):
        own = rng.choice(["p"] * 9 + ["li", "h2", "blockquote"])
        text = rng.choice(phrases if own in ("h2", "li") or rng.random() < 0.15 else paragraphs)
        page.append((Block(text, inside.under([f"t:{own}"]), own, len(text) // 10 if rng.random() < 0.15 else 0), 1))
        if rng.random() < 0.08:
            part(rng.choice(["advert", "share", "side", "form"]), inside)
    for kind in ("share", "form", "comment", "side", "advert", "footer", "notice"):
        if rng.random() < 0.5:
            part(kind, inside if kind in ("share", "comment", "form") and rng.random() < 0.4 else outer)
    return page


def training_pages(pages: list[str], made: int = 400, seed: int = 11) -> list[tuple[list[Block], list[int]]]:
    """Labelled pages from a bounded list of raw ones, and ``made`` layouts filled with their text."""
    rng = random.Random(seed)
    labelled, paragraphs, phrases = [], [], []
    for raw in pages:
        page = blocks(raw)
        for block in page:
            (paragraphs if block.text.count(" ") > 11 else phrases).append(block.text)
        labels = self_labelled(page)
        if labels is None:
            continue
        if len(labelled) % 2:
            page = without(page, MARKS)
        labelled.append((page, labels))
    paragraphs = paragraphs or ["This is a line of text that stands for a whole paragraph of some article here."]
    phrases = phrases or ["A short line"]
    for _ in range(made):
        page = made_page(paragraphs, phrases, rng)
        labelled.append(([b for b, _ in page], [label for _, label in page]))
    return labelled


def learn_chain(pages: DataFrame, sample: int = 300, html: str = "html", page_id: str = "page_id") -> ChainModel:
    """A model from at most ``sample`` pages and made layouts.

    Of all pages that mark their article those with the smallest hash of their id; if they are too few, other pages
    by the same order, whose text fills the layouts. Pages are looked through in that order, first some, then more of
    them, until enough are found, so where many pages mark their article only a small part is parsed here.
    """
    usable = pages.filter(F.col(html).isNotNull() & F.col(page_id).isNotNull()).select(page_id, html)
    schema = type(usable.schema)(list(usable.schema.fields)).add("_unmarked", "boolean")
    by_hash = F.xxhash64(page_id)
    part = min(1.0, 20 * sample / max(1, pages.count()))
    while True:
        some = usable.filter(by_hash < -(2**63) + int(part * 2**64)) if part < 1 else usable
        marked = some.mapInArrow(_find_marked, schema)
        rows = marked.orderBy("_unmarked", by_hash, page_id, html).limit(sample).collect()
        if part == 1 or (len(rows) == sample and not rows[-1]["_unmarked"]):
            return train_chain(training_pages([r[html] for r in rows]))
        part = min(1.0, part * 16)


MAY_MARK = re.compile(r"<(?:article|main)[\s/>]", re.I)


def _find_marked(batches):
    """(page id, page, whether the page leaves its article unmarked) of (page id, page)."""
    for batch in batches:
        for first in range(0, batch.num_rows, 500):
            part = batch.slice(first, 500)
            pages = (p.as_py() for p in part.column(1))
            unmarked = [not MAY_MARK.search(p) or self_labelled(blocks(p)) is None for p in pages]
            yield pa.RecordBatch.from_arrays([*part.columns, pa.array(unmarked, pa.bool_())], [*batch.schema.names, "_unmarked"])


def extract_text(pages: DataFrame, model: ChainModel, html: str = "html") -> DataFrame:
    """All rows with ``main_text`` and ``main_chars``, its number of code points.

    The blocks of main text in page order, a line each. Null and empty pages, and pages without main text, have an
    empty text. Rows that repeat give the same text. Other columns are kept unless they have those two names.
    """
    shared = pages.sparkSession.sparkContext.broadcast(model)
    at = pages.columns.index(html)
    names = [*pages.columns, "main_text", "main_chars"]

    def run(batches):
        model = shared.value
        for batch in batches:
            for first in range(0, batch.num_rows, 500):
                part = batch.slice(first, 500)
                texts = [model.extract(p.as_py()) for p in part.column(at)]
                columns = [*part.columns, pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())]
                yield pa.RecordBatch.from_arrays(columns, names)

    schema = pages.schema
    out = type(schema)(list(schema.fields)).add("main_text", "string").add("main_chars", "long")
    return pages.mapInArrow(run, out)
