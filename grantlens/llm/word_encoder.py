"""Whole texts to token ids, with the ids of each word looked up instead of computed again.

For tokenizers that never join text across white space, the ids of a text are the ids of its words, one
after another. Words are kept in a bounded cache; only unseen ones go to the tokenizer. Each different word of a stretch
of texts is looked up once; the ids of the texts are then gathered from those of the words.
"""

from collections.abc import Iterator
from itertools import chain, repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from tokenizers import Tokenizer

from grantlens.llm.kept import kept

WORD_END = "</w>"
MARKS = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"  # ASCII: a row of them after letters is a word of its own
MARK = ","


def _ranges(starts: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(the places of stretches, one stretch after another; where each begins among them, and the end)."""
    cuts = np.concatenate([[0], np.cumsum(sizes)])
    return np.arange(cuts[-1]) + np.repeat(starts - cuts[:-1], sizes), cuts


class WordEncoder:
    """Ids as little-endian unsigned 32-bit numbers. ``most_words`` bounds the cache; of a full one the words that came
    again stay, the commonest first, and at most half."""

    def __init__(self, path: str, most_words: int = 400_000, longest: int = 64):
        self.tokenizer = Tokenizer.from_file(path)
        self.most_words, self.longest = most_words, longest
        self.known: dict[bytes, int] = {b"": 0}  # the number of a word; its ids are ids[starts[n] : starts[n + 1]]
        self.ids, self.starts = np.zeros(0, dtype="<u4"), np.zeros(2, dtype=np.int64)
        self.uses = np.zeros(1, dtype=np.int64)
        self.splits: dict[str, bool] = {}
        vocabulary = self.tokenizer.get_vocab()
        self.ends = np.zeros(max(vocabulary.values()) + 1, dtype=bool)
        for token, number in vocabulary.items():
            self.ends[number] = token.endswith(WORD_END)

    def _whole(self, texts: list[str]) -> list[list[int]]:
        return [x.ids for x in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _each(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids, how many of each text), each encoded alone."""
        found = self._whole(texts)
        sizes = np.fromiter(map(len, found), dtype=np.int64, count=len(found))
        return np.fromiter(chain.from_iterable(found), dtype="<u4", count=int(sizes.sum())), sizes

    def _letters(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Words of letters alone, joined into one text; every such word has one last token."""
        ids = np.array(self._whole([" ".join(words)])[0], dtype="<u4")
        sizes = np.diff(np.flatnonzero(self.ends[ids]), prepend=-1)
        return (ids, sizes) if len(sizes) == len(words) else self._each(words)

    def _splits_after(self, letter: str) -> bool:
        """Whether a mark stays apart from a letter before it: not if the normalizer ends the letter with a sign of its own."""
        if letter not in self.splits:
            both, alone, mark = self._whole([letter + MARK, letter, MARK])
            self.splits[letter] = both == alone + mark
        return self.splits[letter]

    def _learn(self, unseen: pa.Array, names: list[bytes]) -> None:
        """Adds different words, given as texts and as bytes. Each is made of two parts: letters and the marks after them, or
        itself and nothing."""
        base = pc.utf8_rtrim(unseen, MARKS)
        last = pc.utf8_slice_codeunits(base, -1).dictionary_encode()
        apart = [x.isalpha() and self._splits_after(x) for x in last.dictionary.to_pylist()]
        apart = pc.or_(pc.equal(base, unseen), pa.array(apart, pa.bool_()).take(last.indices))
        simple = pc.and_(pc.utf8_is_alpha(base), apart).to_numpy(zero_copy_only=False)
        letters = base.filter(pa.array(simple)).dictionary_encode()
        asked = letters.dictionary.cast(pa.binary()).to_numpy(zero_copy_only=False).tolist()
        here = np.fromiter(map(self.known.get, asked, repeat(-1)), dtype=np.int64, count=len(asked))
        old, new = np.flatnonzero(here >= 0), np.flatnonzero(here < 0)
        ends = pc.binary_length(base).to_numpy()[simple].tolist()
        tails = [names[at][end:] for at, end in zip(np.flatnonzero(simple).tolist(), ends)]
        marks = {tail: n for n, tail in enumerate(dict.fromkeys([b"", *tails]))}
        others = unseen.filter(pa.array(~simple)).to_pylist()
        known, cuts = self._gathered(here[old])
        lots = [
            (known, np.diff(cuts)),
            self._letters(letters.dictionary.take(pa.array(new)).to_pylist()),
            self._each([m.decode() for m in marks]),
            self._each(others),
        ]
        ids, sizes = (np.concatenate(x) for x in zip(*lots))
        place = np.empty(len(asked), dtype=np.int64)
        place[np.concatenate([old, new])] = np.arange(len(asked))
        parts = np.full((len(names), 2), len(asked), dtype=np.int64)
        parts[simple, 0] = place[letters.indices.to_numpy()]
        parts[simple, 1] += np.fromiter(map(marks.__getitem__, tails), dtype=np.int64, count=len(tails))
        parts[~simple, 0] += len(marks) + np.arange(len(others))
        at, cuts = _ranges((np.cumsum(sizes) - sizes)[parts.ravel()], sizes[parts.ravel()])
        self.known.update(zip(names, range(len(self.uses), len(self.uses) + len(names))))
        self.starts = np.concatenate([self.starts, self.starts[-1] + cuts[2::2]])
        self.ids = np.concatenate([self.ids, ids[at]])
        self.uses = np.concatenate([self.uses, np.zeros(len(names), dtype=np.int64)])

    def _gathered(self, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(the ids of words, one after another; where each word's begin, and the end)."""
        places, cuts = _ranges(self.starts[numbers], self.starts[numbers + 1] - self.starts[numbers])
        return self.ids[places], cuts

    def _shrink(self) -> None:
        again = np.flatnonzero(self.uses > 1)
        again = again[again > 0]
        stay = np.sort(again[np.argsort(-self.uses[again], kind="stable")[: self.most_words // 2]])
        stay = np.concatenate([[0], stay])
        new = np.full(len(self.uses), -1, dtype=np.int64)
        new[stay] = np.arange(len(stay))
        self.known = {word: n for word, old in self.known.items() if (n := int(new[old])) >= 0}
        self.ids, self.starts = self._gathered(stay)
        self.uses = np.ones(len(stay), dtype=np.int64)

    def encode_array(self, texts: pa.Array) -> list[bytes]:
        """The ids of each text; null is empty. Give a bounded number of characters at once."""
        texts = pc.fill_null(texts, "")
        # The strings of special tokens are matched as written, and a letter with a combining mark (U+0300 to U+033F, U+0344)
        # may compose in one case only; otherwise case does not count.
        raw = texts.cast(pa.binary())
        as_is = pc.or_(pc.match_substring(texts, "<|"), pc.match_substring(raw, b"\xcc"))
        as_is = pc.or_(as_is, pc.match_substring(raw, b"\xcd\x84"))
        split = pc.ascii_split_whitespace(pc.if_else(as_is, texts, pc.ascii_lower(texts)))
        coded = split.flatten().dictionary_encode()
        words = coded.dictionary.cast(pa.binary()).to_numpy(zero_copy_only=False).tolist()
        if len(self.uses) > self.most_words or len(self.ids) > 16 * self.most_words:
            self._shrink()
        numbers = np.fromiter(map(self.known.get, words, repeat(-1)), dtype=np.int64, count=len(words))
        unseen = np.flatnonzero(numbers < 0)
        numbers[unseen] = np.arange(len(self.uses), len(self.uses) + len(unseen))
        if len(unseen):
            self._learn(coded.dictionary.take(pa.array(unseen)), [words[n] for n in unseen.tolist()])
        places = coded.indices.to_numpy()
        self.uses[numbers] += np.bincount(places, minlength=len(words))
        ids, cuts = self._gathered(numbers[places])
        for n in unseen.tolist():
            if len(words[n]) > self.longest:
                del self.known[words[n]]
                self.uses[numbers[n]] = 0
        raw, at = ids.tobytes(), (cuts[np.concatenate([[0], np.cumsum(split.value_lengths().to_numpy())])] * 4).tolist()
        return [raw[a:b] for a, b in zip(at, at[1:])]

    def encode_all(self, texts: list[str | None]) -> list[bytes]:
        return self.encode_array(pa.array([t and t.encode("utf-8", "replace").decode() for t in texts], pa.string()))


def encoder_for(path: str) -> WordEncoder:
    """One encoder for each Python worker, kept until the worker needs something else."""
    return kept(("words", path), lambda: WordEncoder(path))


def encoded(path: str, batches, key: int, text: int, characters: int = 2_500_000) -> Iterator[tuple]:
    """(key, ids) of every row of Arrow batches, encoding texts of about ``characters`` bytes at once."""
    encoder = encoder_for(path)
    for batch in batches:
        keys, texts = batch.column(key), batch.column(text)
        stretch = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64)) // characters
        cuts = [*np.flatnonzero(np.diff(stretch, prepend=-1)).tolist(), batch.num_rows]
        for a, b in zip(cuts, cuts[1:]):
            yield from zip(keys.slice(a, b - a).to_pylist(), encoder.encode_array(texts.slice(a, b - a)))
