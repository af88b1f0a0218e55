"""Language identification by partial matching: the language whose model codes a text shortest.

Each language has a tree of byte contexts of up to ``order`` bytes, counted in labelled texts and then
frozen. A byte is coded in the longest context seen; where that context has not seen the byte, an escape
is coded (method C: the escape counts as often as there are different bytes in the context) and the
next shorter context is asked, without the bytes already ruled out. Below the empty context all bytes
left are equal. Contexts lie within a word and the white space before it, so a word's code length does
not depend on its neighbours and is computed once per task for all its copies.

A text is also coded by a model of no language: one bit tells whether labelled texts have the byte, and all bytes that they
have, or have not, are equally likely. The score is the share that the best language has of the probability that all these models give the
text: texts in a script or a language that was not learned, and noise, cost more bits in every tree than there, and score low.
"""

import string
import uuid
from collections import Counter
from collections.abc import Iterator
from itertools import chain, repeat
from math import log2

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from grantlens.llm.kept import kept
from grantlens.sources.storage import written_while

UNDETERMINED = "und"
MARKS = string.punctuation
LETTERS = regex.compile(r"\p{L}[\p{L}\p{M}]*")


def grams(word: str, order: int):
    """Every byte of the word, and the end, behind each of its contexts."""
    coded = b" " + word.encode("utf-8", "replace") + b" "
    for at in range(1, len(coded)):
        for k in range(min(order, at) + 1):
            yield coded[at - k : at + 1]


class ContextTrees:
    """Frozen trees of all languages: ``counts[context][byte]`` has a count for each language."""

    def __init__(self, rows, order: int):
        self.order = order
        self.languages = sorted({lang for lang, _, _ in rows})
        number = {lang: n for n, lang in enumerate(self.languages)}
        self.trees: list[dict[bytes, dict[int, int]]] = [{} for _ in self.languages]
        for lang, gram, n in rows:
            self.trees[number[lang]].setdefault(bytes(gram[:-1]), {})[gram[-1]] = n
        seen = {gram[-1] for _, gram, _ in rows if len(gram) == 1}
        self.seen = np.isin(np.arange(256), list(seen))
        self.plain = [1 + log2(max(1, n)) for n in (256 - len(seen), len(seen))]  # of a byte labelled texts have not, or have
        self.packed, self.bits = np.zeros(0, dtype=np.uint64), np.zeros((0, len(self.languages)))  # of grams met so far
        self.name = uuid.uuid4().hex

    def scorer(self) -> "Scorer":
        """One scorer, and so one cache of words, for all tasks of a Python worker, until it needs something else."""
        return kept(("language", self.name), lambda: Scorer(self))

    def _bits(self, tree, gram: bytes) -> float:
        context, symbol = gram[:-1], gram[-1]
        chance, ruled_out = 1.0, set()
        for k in range(len(context) + 1):
            seen = tree.get(context[k:])
            if not seen:
                continue
            left = {s: n for s, n in seen.items() if s not in ruled_out} if ruled_out else seen
            if not left:
                continue
            total = sum(left.values()) + len(left)
            if symbol in left:
                return -log2(chance * left[symbol] / total)
            chance *= len(left) / total
            ruled_out.update(left)
        return -log2(chance / max(1, 256 - len(ruled_out)))

    def word(self, word: str) -> list[float]:
        """Bits of the word in each language, and in none."""
        coded = b" " + word.encode("utf-8", "replace") + b" "
        total = [0.0] * len(self.languages)
        for at in range(1, len(coded)):
            gram = coded[max(0, at - self.order) : at + 1]
            total = [bits + self._bits(tree, gram) for bits, tree in zip(total, self.trees)]
        return [*total, sum(self.plain[int(self.seen[s])] for s in coded[1:])]

    def _rows(self, grams: np.ndarray) -> np.ndarray:
        """Bits in each language of ascending packed grams; at most 200,000 are kept beside those asked for."""
        missing = grams[~np.isin(grams, self.packed, assume_unique=True)]
        if len(missing):
            raw = [x[-(x[0] + 1) :] for x in map(int.to_bytes, missing.tolist(), repeat(8))]
            rows = np.array([[self._bits(tree, gram) for tree in self.trees] for gram in raw])
            if len(self.packed) > 200_000:
                stay = np.isin(self.packed, grams, assume_unique=True)
                self.packed, self.bits = self.packed[stay], self.bits[stay]
            packed = np.concatenate([self.packed, missing])
            order = np.argsort(packed)
            self.packed, self.bits = packed[order], np.concatenate([self.bits, rows])[order]
        return self.bits[np.searchsorted(self.packed, grams)]

    def words(self, words: list[str]) -> np.ndarray:
        """``word`` of each word: the bits of its bytes, added up from the first to the last.

        A byte and its context are packed into one number, the context's length in front; longer contexts are coded word by word.
        """
        if self.order > 6:
            return np.array([self.word(word) for word in words])
        raw = [b" " + word.encode("utf-8", "replace") + b" " for word in words]
        size = np.fromiter(map(len, raw), dtype=np.int64, count=len(raw))
        order = np.argsort(-size, kind="stable")
        raw, size = [raw[n] for n in order.tolist()], size[order]
        text = np.frombuffer(b"".join(raw), dtype=np.uint8)
        starts = np.cumsum(size) - size
        at = np.arange(len(text)) - np.repeat(starts, size)
        packed = np.zeros(len(text), dtype=np.uint64)
        for back in range(self.order, -1, -1):
            before = np.concatenate([np.zeros(back, dtype=np.uint8), text])[: len(text)]
            packed = packed << np.uint64(8) | np.where(at >= back, before, 0).astype(np.uint64)
        packed |= np.minimum(at, self.order).astype(np.uint64) << np.uint64(56)
        grams, place = np.unique(packed[at > 0], return_inverse=True)
        bits = self._rows(grams)
        total = np.zeros((len(raw), len(self.languages) + 1))
        starts -= np.arange(len(raw))  # the first byte of a word is only context
        for n in range(int(size[0]) - 1):
            long = int(np.searchsorted(-size, -(n + 1)))
            total[:long, :-1] += bits[place[starts[:long] + n]]
        known = np.add.reduceat((self.seen[text] & (at > 0)).astype(np.int64), np.cumsum(size) - size)
        of_none = known * np.longdouble(self.plain[1]) + (size - 1 - known) * np.longdouble(self.plain[0])
        total[:, -1] = of_none.astype(np.float64)
        found = np.empty_like(total)
        found[order] = total
        return found


class Scorer:
    """Sums words' code lengths; the words are cached up to ``most_words``. Of a full cache those that came again stay, the
    commonest first, and at most half."""

    def __init__(self, trees: ContextTrees, most_words: int = 400_000):
        self.trees, self.most_words = trees, most_words
        self.known: dict[str, int] = {}
        self.table = np.zeros((0, len(trees.languages) + 2))  # the last two columns are for no language and count letters
        self.uses = np.zeros(0, dtype=np.int64)

    def _learn(self, tokens: list[str]) -> None:
        """Adds tokens: the sums of their words, the first words of all tokens first, then the second ones."""
        cut = []
        for token in tokens:
            base = token.rstrip(MARKS)
            cut.append([base] if base.isascii() and base.isalpha() else LETTERS.findall(token))
        number = {word: n for n, word in enumerate(dict.fromkeys(chain.from_iterable(cut)))}
        rows = np.zeros((len(tokens), self.table.shape[1]))
        if number:
            bits, letters = self.trees.words(list(number)), np.fromiter(map(len, number), dtype=np.int64, count=len(number))
            for depth in range(max(map(len, cut))):
                at = [n for n, words in enumerate(cut) if len(words) > depth]
                words = np.fromiter((number[cut[n][depth]] for n in at), dtype=np.int64, count=len(at))
                rows[at, :-1] += bits[words]
                rows[at, -1] += letters[words]
        self.known.update(zip(tokens, range(len(self.table), len(self.table) + len(tokens))))
        self.table = np.concatenate([self.table, rows])
        self.uses = np.concatenate([self.uses, np.zeros(len(tokens), dtype=np.int64)])

    def _shrink(self) -> None:
        again = np.flatnonzero(self.uses > 1)
        stay = np.sort(again[np.argsort(-self.uses[again], kind="stable")[: self.most_words // 2]])
        new = np.full(len(self.uses), -1, dtype=np.int64)
        new[stay] = np.arange(len(stay))
        self.known = {token: n for token, old in self.known.items() if (n := int(new[old])) >= 0}
        self.table, self.uses = self.table[stay], np.ones(len(stay), dtype=np.int64)

    def predict_all(self, texts: pa.Array, characters: int = 2_000_000) -> Iterator[tuple[str, float]]:
        """``predict`` of each text, learning the words of about ``characters`` bytes of texts at once."""
        stretch = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64)) // characters
        cuts = [*np.flatnonzero(np.diff(stretch, prepend=-1)).tolist(), len(texts)]
        for a, b in zip(cuts, cuts[1:]):
            split = [(text or "").lower().split() for text in texts.slice(a, b - a).to_pylist()]
            if not self.trees.languages:
                split = [[] for _ in split]
            if len(self.known) > self.most_words:
                self._shrink()
            unseen = list(set().union(*split).difference(self.known))
            if unseen:
                self._learn(unseen)
            for words in split:
                yield self._best(words)

    def predict(self, text: str | None) -> tuple[str, float]:
        """The language and its share of the probability that all models, that of no language too, give the text.

        Without a letter, or without a model, it is ``und`` and 0. Ties go to the first by name.
        """
        return next(self.predict_all(pa.array([text and text.encode("utf-8", "replace").decode()], pa.string())))

    def _best(self, words: list[str]) -> tuple[str, float]:
        if not words:
            return UNDETERMINED, 0.0
        places = np.fromiter(map(self.known.__getitem__, words), dtype=np.int64, count=len(words))
        self.uses[places] += 1  # once for each text
        total = self.table[places].sum(axis=0)
        if not total[-1]:
            return UNDETERMINED, 0.0
        bits = total[:-1]
        best = int(bits[:-1].argmin())
        return self.trees.languages[best], float(1.0 / np.exp2(np.minimum(bits[best] - bits, 1000)).sum())


def learn_trees(
    labelled: DataFrame,
    order: int = 4,
    texts_per_language: int = 500,
    grams_per_language: int = 60_000,
    doc_id: str = "doc_id",
    text: str = "text",
    lang: str = "lang",
) -> ContextTrees:
    """Trees from whole texts of at most ``texts_per_language`` labelled rows of each language.

    The rows are those with the smallest hash of doc_id, sought among the lowest hashes only: of a language with n labels
    those below ``4 * texts_per_language / n`` of the range. Rows with null text or label are not used.
    Each tree keeps its most frequent contexts, whole ones, so that escapes stay exact: as many as have at most
    ``grams_per_language`` (context, byte) counts together, those with the same total all or none. The model that
    the driver holds is bounded by this number times the number of languages.
    """
    sizes = {r[0]: r[1] for r in labelled.filter(F.col(lang).isNotNull()).groupBy(lang).count().collect()}
    if not sizes:
        return ContextTrees([], order)
    below = {l: min(2**63 - 1, -(2**63) + 4 * texts_per_language * 2**64 // n) for l, n in sizes.items()}
    limit = F.create_map(*[F.lit(x) for pair in below.items() for x in pair])[F.col(lang)]
    usable = labelled.filter(F.col(lang).isNotNull() & F.col(text).isNotNull() & (F.xxhash64(doc_id) <= limit))
    by_hash = Window.partitionBy(lang).orderBy(F.xxhash64(doc_id), F.col(doc_id))
    ids = usable.select(doc_id, lang).withColumn("_n", F.row_number().over(by_hash))
    ids = ids.filter(F.col("_n") <= texts_per_language).select(doc_id).distinct()
    sample = usable.select(doc_id, lang, text).join(F.broadcast(ids), doc_id, "left_semi")
    sample = sample.withColumn("_n", F.row_number().over(by_hash)).filter(F.col("_n") <= texts_per_language)

    def count(batches):
        counts: dict[str, Counter] = {}
        for batch in batches:
            for label, value in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                words = Counter(LETTERS.findall(value.lower()))
                into = counts.setdefault(label, Counter())
                for word, n in words.items():
                    for gram in grams(word, order):
                        into[gram] += n
        for label, counter in counts.items():
            keys = list(counter)
            yield pa.RecordBatch.from_pydict(
                {
                    "lang": [label] * len(keys),
                    "context": [k[:-1] for k in keys],
                    "symbol": [k[-1] for k in keys],
                    "n": [counter[k] for k in keys],
                },
                schema=pa.schema([("lang", pa.string()), ("context", pa.binary()), ("symbol", pa.int32()), ("n", pa.int64())]),
            )

    counted = sample.select(lang, text).repartition(8).mapInArrow(count, "lang string, context binary, symbol int, n long")
    summed = counted.groupBy("lang", "context", "symbol").agg(F.sum("n").alias("n"))
    contexts = summed.groupBy("lang", "context").agg(
        F.sum("n").alias("total"), F.collect_list(F.struct("symbol", "n")).alias("seen")
    )
    with written_while(contexts, "language-contexts") as contexts:
        # One row for each total that occurs, however many contexts have it.
        totals = contexts.groupBy("lang", "total").agg(F.sum(F.size("seen")).alias("symbols"))
        often = Window.partitionBy("lang").orderBy(F.desc("total"))
        fits = totals.withColumn("sum", F.sum("symbols").over(often)).filter(F.col("sum") <= grams_per_language)
        least = fits.groupBy("lang").agg(F.min("total").alias("least"))
        kept = contexts.join(least, "lang").filter("total >= least").collect()
    return ContextTrees([(r["lang"], bytes(r["context"]) + bytes([x]), n) for r in kept for x, n in r["seen"]], order)


def predict_language(documents: DataFrame, trees: ContextTrees, text: str = "text") -> DataFrame:
    """All rows with ``lang_pred`` and ``lang_score``; the text alone decides.

    Null texts and texts without a letter are ``und`` with score 0, and so is every text if nothing was
    learned. Rows that repeat are scored alike; other columns are kept, whatever their names, as long as
    they are not those two.
    """
    shared = documents.sparkSession.sparkContext.broadcast(trees)
    at = documents.columns.index(text)
    names = [*documents.columns, "lang_pred", "lang_score"]

    def run(batches):
        scorer = shared.value.scorer()
        for batch in batches:
            found = list(scorer.predict_all(batch.column(at)))
            columns = [
                *batch.columns,
                pa.array([f[0] for f in found], pa.string()),
                pa.array([f[1] for f in found], pa.float64()),
            ]
            yield pa.RecordBatch.from_arrays(columns, names)

    schema = documents.schema
    out = type(schema)(list(schema.fields)).add("lang_pred", "string").add("lang_score", "double")
    return documents.mapInArrow(run, out)


def is_held_out(doc_id: Column) -> Column:
    """crc32 of the id as text leaves 1 modulo 3; a null id is not held out."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))
