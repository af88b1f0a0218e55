"""URL rules held in Bloom filter cascades, with DataFrame functions only.

A cascade is a list of Bloom filters. The first encodes the listed keys, the second those other keys of
the corpus that the first takes for listed, the third the listed keys that the second takes for others,
and so on until no key of the corpus is taken wrongly. A key's first miss then tells its list, and for
the keys the cascade was built over the answer is exact, without a join.

A filter has 1.44 * log2(keys of the corpus / listed keys) bits for each listed key at the first
level and about as many bits as keys after it. The driver holds these bits, so they grow with the
list and with the logarithm of the corpus, and with nothing else.
"""

import math
from collections.abc import Iterable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from grantlens.sources.storage import written


@dataclass(frozen=True)
class Level:
    """One Bloom filter: its 64-bit words and how many hashes a key has."""

    words: tuple[int, ...]
    hashes: int
    seed: int

    def positions(self, key: Column) -> list[Column]:
        bits = F.lit(64 * len(self.words))
        return [F.pmod(F.xxhash64(key, F.lit(self.seed + h)), bits) for h in range(self.hashes)]

    def holds(self, key: Column) -> Column:
        words = F.array(*[F.lit(w) for w in self.words])
        found = F.lit(True)
        for at in self.positions(key):
            word = F.element_at(words, (F.floor(at / 64) + 1).cast("int"))
            moved = F.call_function("shiftright", word, F.pmod(at, F.lit(64)).cast("int"))
            found = found & (moved.bitwiseAND(F.lit(1)) == 1)
        return found


def _level(keys: DataFrame, count: int, per_key: float, hashes: int, seed: int) -> Level:
    words = max(1, math.ceil(count * per_key / 64))
    empty = Level((0,) * words, hashes, seed)
    bits = keys.select(F.explode(F.array(*empty.positions(F.col("key")))).alias("at"))
    mask = F.call_function("shiftleft", F.lit(1).cast("long"), F.pmod("at", F.lit(64)).cast("int"))
    rows = bits.groupBy(F.floor(F.col("at") / 64).alias("word")).agg(F.bit_or(mask).alias("bits")).collect()
    filled = [0] * words
    for row in rows:  # one row per word of the filter
        filled[row["word"]] = row["bits"]
    return Level(tuple(filled), hashes, seed)


def build_cascade(listed: Sequence[str], universe: DataFrame, first_seed: int = 0) -> list[Level]:
    """The levels for ``listed`` over ``universe``, a stored table with one row per ``key``.

    An empty list gives no level at all; an empty universe gives one.
    """
    spark = universe.sparkSession
    keys = sorted(set(listed))
    if not keys:
        return []
    inside = spark.createDataFrame([(k,) for k in keys], "key string")
    outside = universe.join(inside, "key", "left_anti")
    n_inside, n_outside = len(keys), universe.count()
    rate = max(2.0, n_outside / n_inside)
    levels: list[Level] = []
    per_key, hashes = 1.44 * math.log2(rate), max(1, round(math.log2(rate)))
    while True:
        level = _level(inside, n_inside, per_key, hashes, first_seed + 1000 * len(levels))
        levels.append(level)
        wrong = written(outside.filter(level.holds(F.col("key"))), "cascade")
        n_wrong = wrong.count()
        if n_wrong == 0:
            return levels
        # The other list's mistaken keys are what the next filter encodes.
        inside, outside, n_inside = wrong, inside, n_wrong
        per_key, hashes = 1.44, 1


def in_cascade(key: Column, levels: Sequence[Level]) -> Column:
    """Whether the key is listed: the first filter that misses it decides, else the last one."""
    answer = F.lit(len(levels) % 2 == 1)
    for depth in range(len(levels) - 1, -1, -1):
        answer = F.when(~levels[depth].holds(key), F.lit(depth % 2 == 1)).otherwise(answer)
    return answer


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; else empty."""
    host = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    letters = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return F.coalesce(F.translate(host, letters, letters.lower()), F.lit(""))


def path_of(url: Column) -> Column:
    """After the host up to ``?``, ``#`` or the end; empty where there is no host part."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def candidate_keys(host: Column, path: Column, labels: int, lengths: Iterable[int]) -> Column:
    """The rules that could fit, longest first: host ends of up to ``labels`` labels, each with the
    path's beginnings of the given lengths (those of the rules; a shorter path has no such beginning)."""
    entries = []
    for n in range(1, labels + 1):
        # A shorter host gives itself again; the copy does no harm.
        end = F.substring_index(host, ".", -n)
        for length in sorted(lengths):
            key = F.concat(end, F.substring(path, 1, length))
            entry = F.struct(F.length(key).alias("length"), F.length(end).alias("host"), key.alias("key"))
            entries.append(F.when((F.length(path) >= length) & (host != ""), entry))
    return F.sort_array(F.filter(F.array(*entries), lambda e: e.isNotNull()), asc=False)


def judge_urls(
    pages: DataFrame,
    block: Sequence[tuple[str, str]],
    allow: Sequence[tuple[str, str]],
    url: str = "url",
    otherwise: str = "allow",
) -> DataFrame:
    """All rows with ``_url_host``, ``_url_path``, ``_url_rule`` and ``_url_verdict``.

    A rule (host, path) fits its host and all hosts below it where the path starts with the rule's. The
    longest fitting rule decides (of equal lengths that with the longer host); a URL that no rule fits
    is ``otherwise``: it is on no list. Null URLs, and those without ``://``, have empty host and path and
    fit no rule. Rows that repeat are judged alike. Other columns are kept unless they start with ``_url_``.
    """
    text = lambda rules: [h.lower() + p for h, p in rules]
    blocked, allowed = text(block), text(allow)
    if both := set(blocked) & set(allowed):
        raise ValueError(f"rules on both lists: {sorted(both)}")
    rules = [*block, *allow]
    labels = max((h.count(".") + 1 for h, _ in rules), default=1)
    lengths = sorted({len(p) for _, p in rules})
    host, path = host_of(F.col(url)), path_of(F.col(url))
    parts = pages.select(host.alias("_url_host"), path.alias("_url_path"))
    keys = candidate_keys(F.col("_url_host"), F.col("_url_path"), labels, lengths)
    universe = written(
        parts.select(F.explode(keys).alias("entry")).select(F.col("entry.key").alias("key")).distinct(), "url-keys"
    )
    blocks, allows = build_cascade(blocked, universe), build_cascade(allowed, universe, 500)
    judged = pages.withColumns({"_url_host": host, "_url_path": path}).withColumn(
        "_url_found",
        F.transform(
            keys,
            lambda e: F.struct(
                e["key"].alias("key"),
                F.when(in_cascade(e["key"], blocks), "block")
                .when(in_cascade(e["key"], allows), "allow")
                .alias("verdict"),
            ),
        ),
    )
    found = F.try_element_at(F.filter("_url_found", lambda e: e["verdict"].isNotNull()), F.lit(1))
    return judged.withColumn("_url_found", found).select(
        *[F.col(f"`{c}`") for c in pages.columns],
        "_url_host",
        "_url_path",
        F.col("_url_found.key").alias("_url_rule"),
        F.coalesce(F.col("_url_found.verdict"), F.lit(otherwise)).alias("_url_verdict"),
    )
