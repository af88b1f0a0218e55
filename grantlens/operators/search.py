"""Ranked text search over patents: an inverted index kept in DataFrames.

The index has four tables: ``postings`` (term, patent_id, tf, doc_len, positions), ``documents`` (patent_id,
doc_len), ``terms`` (term, n_docs, n_hits) and the one-row ``corpus`` (n_docs, n_tokens). The document
length is repeated in the postings so that scoring needs no join by document. Positions count the words of title and
abstract together, with one free place between the two, so that no phrase runs from one into the other. Stored indexes,
and keeping them current, are in ``grantlens.sources.index_store``.
"""

from collections.abc import Callable
from contextlib import ExitStack
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from grantlens.functions.joins import if_small
from grantlens.functions.ranking import top_n_per_group
from grantlens.functions.stem import stem as stem_of
from grantlens.functions.text import (
    MIN_QUERY_LENGTH,
    file_slug,
    fold_case,
    normalize_query,
    raw_words,
)
from grantlens.schema import DAYS_PER_YEAR
from grantlens.sources.storage import written, written_while

# The usual BM25 parameters and the least weight of a term.
K1, B, MIN_IDF = 1.2, 0.75, 1e-6
BANDS = 8  # of document lengths, to each doubling
FIRST = 4  # times k: how many hits the first bands of a query may have together
GRAM, RAREST = 3, 4  # characters of a title gram; how many grams of a query are looked up
MOST_HITS = 200_000  # that are broadcast
MOST_SPANS = 500  # terms whose bands are told to the reader
TEXT_PER_TASK = 16_000_000  # bytes of text that one task cuts into words
SPREAD_BITS, WITHIN_BITS = 6, 20  # of a patent's hash: the last ones order the tasks, the next ones deal within them
ROUNDING = 2e-6  # by which scores and bounds may differ
# The columns of a result table.
RESULT_COLUMNS = [
    "patent_id",
    "title",
    "year",
    "patent_type",
    "num_claims",
    "grant_lag_days",
    "filing_date",
]


@dataclass
class SearchIndex:
    postings: DataFrame
    documents: DataFrame
    terms: DataFrame
    corpus: DataFrame
    stemmed: bool = False
    tokenizer: str = "ascii"
    buckets: int = 0  # of a stored index: the postings are in folders by term bucket
    blocks: DataFrame | None = None  # of a stored index: (bucket, term, band, n, max_tf, min_len) of its postings
    dead: DataFrame | None = None  # of a stored index: (patent_id, segment) whose postings no longer count
    facts: tuple[int, float] | None = None  # of a stored index: its documents and their mean length, once they were read
    by_patent: DataFrame | None = None  # of a built index: the postings as one row for each document
    each_once: bool = False  # whether ``by_patent`` has one row for every document, so that it tells their lengths

    def live_postings(self) -> DataFrame:
        """(term, patent_id, tf, doc_len, positions) of everything that counts."""
        return without_dead(self.postings, self.dead).select("term", "patent_id", "tf", "doc_len", "positions")


def without_dead(postings: DataFrame, dead: DataFrame | None) -> DataFrame:
    return postings if dead is None else postings.join(dead, ["patent_id", "segment"], "left_anti")


def index_rows(index: SearchIndex) -> DataFrame:
    """All that an index says in one table: (kind, term, patent_id, n, m) for postings (tf, doc_len), terms
    (n_docs, n_hits), documents (1, doc_len) and the corpus (n_docs, n_tokens)."""
    none = F.lit(None).cast("string")

    def part(kind, frame, term, patent, n, m):
        columns = [F.lit(kind).alias("kind"), term.alias("term"), patent.alias("patent_id")]
        return frame.select(*columns, n.cast("bigint").alias("n"), m.cast("bigint").alias("m"))

    col = F.col
    return (
        part("posting", index.live_postings(), col("term"), col("patent_id"), col("tf"), col("doc_len"))
        .unionByName(part("term", index.terms, col("term"), none, col("n_docs"), col("n_hits")))
        .unionByName(part("document", index.documents, none, col("patent_id"), F.lit(1), col("doc_len")))
        .unionByName(part("corpus", index.corpus, none, none, col("n_docs"), col("n_tokens")))
    )


# ---- index ------------------------------------------------------------------------------------


def doc_lengths(docs: DataFrame, tokenizer: str = "ascii") -> DataFrame:
    """Words per document; counting needs no case folding and keeps no words."""
    texts = [F.size(raw_words(F.col(c), tokenizer)) for c in ("title", "abstract")]
    return docs.select("patent_id", (texts[0] + texts[1]).alias("doc_len"))


def _words(docs: DataFrame, tokenizer: str) -> DataFrame:
    """(patent_id, doc_len, position, term), one row per word of title and abstract.

    The outer explode is on purpose: for a plain one Spark infers a filter on the array and moves it
    to the scan, which splits every text a second time.
    """
    title, abstract = (raw_words(F.col(c), tokenizer) for c in ("title", "abstract"))
    words = F.concat(title, F.array(F.lit("")), abstract)
    return (
        docs.select("patent_id", words.alias("words"))
        .select("patent_id", (F.size("words") - 1).alias("doc_len"), F.posexplode_outer("words").alias("position", "word"))
        .filter("word <> ''")
        .select("patent_id", "doc_len", "position", fold_case(F.col("word"), tokenizer).alias("term"))
    )


def _by_row(docs: DataFrame, tokenizer: str) -> DataFrame:
    """(patent_id, doc_len, terms): one row per row of ``docs``, with its terms in order as structs of term, tf and
    positions; null without words.

    A text's words are sorted within its row, so nothing is gathered over rows, shuffled or spilled. Every step
    reads the array before it more than once, which keeps Spark from putting the steps into each other's functions.
    """
    title, abstract = (raw_words(F.col(c), tokenizer) for c in ("title", "abstract"))
    words = F.concat(title, F.array(F.lit("")), abstract)
    place = lambda word, at: F.struct(fold_case(word, tokenizer).alias("term"), at.alias("position"))
    placed = F.sort_array(F.filter(F.transform("words", place), lambda x: x["term"] != ""))
    is_first = lambda at: F.get("placed", at - 2)["term"].eqNullSafe(F.get("placed", at - 1)["term"])
    starts = F.filter(F.sequence(F.lit(1), F.greatest(F.size("placed"), F.lit(1))), lambda at: ~is_first(at))
    starts = F.when(F.size("placed") > 0, starts)

    def run(start, k):
        tf = F.coalesce(F.get("starts", k + 1), F.size("placed") + 1) - start
        # ``slice`` would copy the whole array for every term.
        positions = F.transform(F.sequence(start, start + tf - 1), lambda at: F.get("placed", at - 1)["position"])
        term = F.get("placed", start - 1)["term"].alias("term")
        return F.struct(term, tf.cast("bigint").alias("tf"), positions.alias("positions"))

    rows = docs.select("patent_id", words.alias("words"))
    rows = rows.select("patent_id", (F.size("words") - 1).alias("doc_len"), placed.alias("placed"))
    rows = rows.select("*", starts.alias("starts"))
    return rows.select("patent_id", "doc_len", F.transform("starts", run).alias("terms"))


def flat_postings(by_patent: DataFrame) -> DataFrame:
    """The outer form is on purpose, as for words."""
    return by_patent.select("patent_id", "doc_len", F.inline_outer("terms")).filter("term IS NOT NULL")


def _extent(docs: DataFrame) -> tuple[bool, int]:
    """Whether a patent_id comes twice, and the bytes of all texts."""
    size = sum(F.coalesce(F.octet_length(c), F.lit(0)) for c in ("title", "abstract"))
    ids = docs.groupBy("patent_id").agg(F.count(F.lit(1)).alias("n"), F.sum(size).alias("size"))
    row = ids.agg(F.coalesce(F.max("n") > 1, F.lit(False)), F.coalesce(F.sum("size"), F.lit(0))).first()
    return row[0], row[1]


def _by_sharing(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The rows with a patent_id of their own, and those that share one."""
    repeated = docs.groupBy(F.col("patent_id").alias("_id")).agg(F.count(F.lit(1)).alias("_n")).filter("_n > 1").drop("_n")
    same = F.col("patent_id").eqNullSafe(F.col("_id"))
    return docs.join(repeated, same, "left_anti"), docs.join(repeated, same, "left_semi")


def _spread(docs: DataFrame, size: int) -> DataFrame:
    """The rows dealt by patent to tasks that cut about TEXT_PER_TASK of the ``size`` bytes of text each."""
    tasks = max(size // TEXT_PER_TASK + 1, docs.sparkSession.sparkContext.defaultParallelism)
    return docs.repartition(tasks, "patent_id")


def _spread_in_order(docs: DataFrame, size: int) -> DataFrame:
    """As ``_spread``, with the tasks in the order of ``hash_of`` modulo 2 ** SPREAD_BITS: a task has few remainders, so what
    is stored in folders by the remainder needs no second shuffle."""
    return in_order_of_hash(docs, max(size // TEXT_PER_TASK + 1, docs.sparkSession.sparkContext.defaultParallelism))


def in_order_of_hash(rows: DataFrame, tasks: int) -> DataFrame:
    """The rows dealt by patent to tasks that are in the order of ``hash_of`` modulo 2 ** SPREAD_BITS."""
    last = hash_of().bitwiseAND(2**SPREAD_BITS - 1)
    within = F.shiftrightunsigned(hash_of(), SPREAD_BITS).bitwiseAND(2**WITHIN_BITS - 1)
    place = F.shiftleft(last, WITHIN_BITS) + within
    return rows.repartitionById(tasks, F.shiftright(place * tasks, SPREAD_BITS + WITHIN_BITS).cast("int"))


def _counts_by_row(docs: DataFrame, tokenizer: str) -> DataFrame:
    """(patent_id, term, tf) of each row by itself: its words are sorted and runs counted, nothing is gathered over rows.

    As in ``_by_row``, every step reads the array before it more than once. The outer form is on purpose, as for words.
    """
    texts = F.concat(*(raw_words(F.col(c), tokenizer) for c in ("title", "abstract")))
    folded = F.sort_array(F.transform(texts, lambda word: fold_case(word, tokenizer)))
    differs = lambda at: ~F.get("words", at - 2).eqNullSafe(F.get("words", at - 1))
    starts = F.filter(F.sequence(F.lit(1), F.greatest(F.size("words"), F.lit(1))), differs)

    def run(start, k):
        tf = F.coalesce(F.get("starts", k + 1), F.size("words") + 1) - start
        return F.struct(F.get("words", start - 1).alias("term"), tf.cast("bigint").alias("tf"))

    rows = docs.select("patent_id", folded.alias("words"))
    rows = rows.select("*", F.when(F.size("words") > 0, starts).alias("starts"))
    return rows.select("patent_id", F.inline_outer(F.transform("starts", run))).filter("term IS NOT NULL")


def postings_by_patent(docs: DataFrame, tokenizer: str = "ascii", unique: bool = False) -> DataFrame:
    """(patent_id, doc_len, terms): the postings of each document. Rows that share patent_id and length are put together;
    ``unique`` says that no patent_id comes twice, and gives a row to documents without words too."""
    if unique:
        return _by_row(docs, tokenizer)
    alone, shared = _by_sharing(docs)
    return _by_row(alone, tokenizer).unionByName(gather_postings(make_postings(shared, False, tokenizer)))


def gather_postings(postings: DataFrame) -> DataFrame:
    """(patent_id, doc_len, terms): the postings of each patent; those that are together already are not moved."""
    return postings.groupBy("patent_id", "doc_len").agg(F.collect_list(F.struct("term", "tf", "positions")).alias("terms"))


def tokenize(docs: DataFrame, tokenizer: str = "ascii") -> DataFrame:
    """(patent_id, term, tf) over title and abstract together."""
    docs = docs.select("patent_id", "title", "abstract")
    shared, size = _extent(docs)
    counted = lambda rows: _words(rows, tokenizer).groupBy("patent_id", "term").agg(F.count(F.lit(1)).alias("tf"))
    if not shared:
        return _counts_by_row(_spread(docs, size), tokenizer)
    alone, together = _by_sharing(docs)
    return _counts_by_row(_spread(alone, size), tokenizer).unionByName(counted(together))


def vocabulary(docs: DataFrame, tokenizer: str = "ascii") -> DataFrame:
    """The distinct words of all documents."""
    return _words(docs, tokenizer).select("term").distinct()


def make_postings(docs: DataFrame, stem: bool = False, tokenizer: str = "ascii") -> DataFrame:
    """(term, patent_id, tf, doc_len, positions)."""
    key = ["patent_id", "doc_len", "term"]
    placed = _words(docs, tokenizer).groupBy(*key).agg(F.collect_list("position").alias("positions"))
    if stem:  # each word of a document once
        stems = placed.withColumn("term", stem_of(F.col("term"))).groupBy(*key)
        placed = stems.agg(F.flatten(F.collect_list("positions")).alias("positions"))
    tf = F.size("positions").cast("bigint").alias("tf")
    return placed.select("term", "patent_id", tf, "doc_len", F.sort_array("positions").alias("positions"))


def term_counts(postings: DataFrame, sign: int = 1) -> DataFrame:
    return postings.groupBy("term").agg(
        (F.count(F.lit(1)) * sign).alias("n_docs"), (F.sum("tf") * sign).alias("n_hits")
    )


def corpus_counts(documents: DataFrame, sign: int = 1) -> DataFrame:
    n_tokens = F.coalesce(F.sum("doc_len"), F.lit(0))
    return documents.agg(
        (F.count(F.lit(1)) * sign).alias("n_docs"), (n_tokens * sign).alias("n_tokens")
    )


def build_index(docs: DataFrame, stem: bool = False, tokenizer: str = "ascii") -> SearchIndex:
    """Full build over documents with a unique patent_id.

    The texts are spread by document once, so that all tasks have some, and none more than its memory holds the terms of;
    counting words and regrouping stems then happen inside those partitions, words row by row, and only per-term counts are
    shuffled again.
    """
    docs = docs.select("patent_id", "title", "abstract")
    shared, size = _extent(docs)
    spread = (_spread if stem or shared else _spread_in_order)(docs, size)
    if not stem:
        by_patent = postings_by_patent(spread, tokenizer, unique=not shared)
        postings = flat_postings(by_patent).select("term", "patent_id", "tf", "doc_len", "positions")
        documents = doc_lengths(spread, tokenizer)
        return SearchIndex(
            postings, documents, term_counts(postings), corpus_counts(documents), stem, tokenizer,
            by_patent=by_patent, each_once=not shared,
        )
    postings = make_postings(spread, stem, tokenizer)
    documents = doc_lengths(spread, tokenizer)
    return SearchIndex(
        postings, documents, term_counts(postings), corpus_counts(documents), stem, tokenizer
    )


def scan_index(docs: DataFrame, tokenizer: str = "ascii") -> SearchIndex:
    """An index that is never stored: a search's term filter reaches down to the tokens, so only the
    words asked for are counted and shuffled."""
    docs = docs.select("patent_id", "title", "abstract")
    postings = make_postings(docs, tokenizer=tokenizer)
    documents = doc_lengths(docs, tokenizer)
    return SearchIndex(
        postings, documents, term_counts(postings), corpus_counts(documents), False, tokenizer
    )


def band_of() -> Column:
    """Documents of about the same length are a band; within one, a term's gain hangs on how often it occurs."""
    return F.floor(F.log2(F.col("doc_len") + 1) * BANDS).cast("int").alias("band")


def hash_of(key: str = "patent_id") -> Column:
    """By which patents are dealt to tasks and to the folders of a stored index."""
    return F.xxhash64(key)


def bucket_of(buckets: int, key: str = "term") -> Column:
    """The folder of a term's postings."""
    return F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int").alias("bucket")


# ---- queries ----------------------------------------------------------------------------------


def as_queries(spark: SparkSession, texts: list[str]) -> DataFrame:
    """(query_id, query) from given texts, as a constant the optimizer knows to be small."""
    rows = [F.struct(F.lit(i).alias("query_id"), F.lit(q).alias("query")) for i, q in enumerate(texts)]
    return spark.range(1, numPartitions=1).select(F.inline(F.array(*rows)))


def normalize_queries(queries: DataFrame) -> DataFrame:
    """Cleaned text per query; queries that are too short or hold no word are left out."""
    clean = queries.withColumn("clean", normalize_query(F.col("query")))
    return clean.filter(F.col("clean").isNotNull())


def _spaced(queries: DataFrame) -> DataFrame:
    """Two spaces between words, so that neighbouring operators do not share one."""
    words = F.regexp_replace(F.trim("clean"), r"\s+", "  ")
    return normalize_queries(queries).withColumn("text", F.concat(F.lit(" "), words, F.lit(" ")))


def _lacks_a_side() -> Column:
    return F.exists(F.split("text", " (?:OR|AND|NOT) "), lambda part: F.trim(part) == "")


def malformed_queries(queries: DataFrame) -> DataFrame:
    """Queries with an operator that lacks a side; the title scan answers them instead."""
    return _spaced(queries).filter(_lacks_a_side()).select("query_id", "query")


def _units(words: Column, stem: bool, tokenizer: str) -> Column:
    """What stands between spaces, as tokens joined by a space: several tokens are a phrase."""

    def unit(chunk: Column) -> Column:
        folded = F.transform(raw_words(chunk, tokenizer), lambda word: fold_case(word, tokenizer))
        return F.array_join(F.transform(folded, stem_of) if stem else folded, " ")

    return F.array_remove(F.transform(F.split(F.trim(words), " +"), unit), "")


def query_terms(queries: DataFrame, stem: bool = False, tokenizer: str = "ascii") -> DataFrame:
    """The terms of the well-formed queries, one row per (group, term).

    NOT binds tightest, then AND, then OR; words side by side form a group. So a query is a list of
    alternatives, each a list of clauses, each a wanted group (part 0) and unwanted ones. Words joined by underscores
    are one term, a phrase: its words with spaces between. All of it is projections of the query text.
    """
    group = ["query_id", "alt", "clause", "n_clauses", "part"]
    parts = (
        _spaced(queries)
        .filter(~_lacks_a_side())
        .select("query_id", F.posexplode(F.split("text", " OR ")).alias("alt", "text"))
        .select("query_id", "alt", F.split("text", " AND ").alias("clauses"))
        .select("*", F.posexplode("clauses").alias("clause", "text"))
        .withColumn("n_clauses", F.size("clauses"))
        .select("*", F.posexplode(F.split("text", " NOT ")).alias("part", "words"))
        .select(*group, _units(F.col("words"), stem, tokenizer).alias("words"))
    )
    return parts.select(
        *group, "words", F.explode(F.array_distinct("words")).alias("term")
    ).select(
        *group,
        "term",
        F.size(F.array_distinct("words")).cast("bigint").alias("n_terms"),
        F.size(F.filter("words", lambda word: word == F.col("term"))).alias("times"),
    )


def phrase_postings(index: SearchIndex, phrases: DataFrame) -> DataFrame:
    """(term, patent_id, tf, doc_len) of phrases (term: words with spaces between): where all words follow each other.

    The lists of the words, each moved back by the word's place in the phrase, are intersected for each patent: a
    group has one list for each word.
    """
    words = phrases.select(F.col("term").alias("phrase"), F.split("term", " ").alias("words"))
    words = words.select("phrase", F.size("words").alias("n"), F.posexplode("words").alias("offset", "term"))
    keys = ["term"]
    if index.buckets:
        words, keys = words.withColumn("bucket", bucket_of(index.buckets)), ["bucket", "term"]
    found = without_dead(index.postings.join(if_small(words), keys), index.dead)
    starts = F.transform("positions", lambda at: at - F.col("offset")).alias("starts")
    lists = found.select("phrase", "patent_id", "doc_len", "n", starts).groupBy("phrase", "patent_id", "doc_len", "n")
    whole = lists.agg(F.collect_list("starts").alias("lists")).filter(F.size("lists") == F.col("n"))
    common = F.aggregate("lists", F.get("lists", F.lit(0)), lambda kept, starts: F.array_intersect(kept, starts))
    counted = whole.select(F.col("phrase").alias("term"), "patent_id", F.size(common).cast("bigint").alias("tf"), "doc_len")
    return counted.filter("tf > 0")


def _term_weights(counts: DataFrame, wanted: DataFrame, stats: Column) -> DataFrame:
    df = F.col("n_docs")
    idf = F.log((stats["n_docs"] - df + 0.5) / (df + 0.5))
    # Reading n_hits as well keeps this branch equal to the one that finds the hits, so that over an
    # index that is not stored Spark counts the words once and reuses that shuffle.
    weight = F.when(F.col("n_hits") > 0, F.greatest(idf, F.lit(MIN_IDF)))
    return counts.join(wanted, "term", "left_semi").select("term", weight.alias("idf"))


def search(index: SearchIndex, queries: DataFrame, k: int = 200, prune: bool = False) -> DataFrame:
    """The k best patents per query: (query_id, patent_id, score).

    The words of a query are wanted together, in title or abstract; AND, OR and NOT in upper case are
    operators, and words joined by underscores a phrase, which counts and scores as one term. The score sums BM25 over
    the wanted terms of every alternative that holds, rounded to 6 decimals; ties go by patent_id.

    The query words, one row each, are broadcast where they are few, so postings are not shuffled by term and, of a
    stored index, only the folders of these words are read. Hits are shuffled once, by (query, patent); the levels of
    grouping that decide a match stay inside those partitions, and the final cut keeps k rows per query
    before its shuffle.
    ``prune`` scores of a stored index only bands that can matter, see ``_pruned``. It takes more jobs, and pays where scores
    differ much between documents; ``postings_read`` tells for given queries. The hits are then a table of their own when this
    returns, and what led to them is deleted.
    """
    if not prune or index.blocks is None:
        return _best(_found(index, queries, k, lambda frame: frame, False), k)
    with ExitStack() as tables:
        kept = lambda frame: tables.enter_context(written_while(frame, "search"))
        return written(_best(_found(index, queries, k, kept, True), k), "hits")


Keep = Callable[[DataFrame], DataFrame]


def _found(index: SearchIndex, queries: DataFrame, k: int, kept: Keep, prune: bool) -> DataFrame:
    """Matches that hold the k best of each query; ``kept`` stores what several steps read."""
    terms = kept(query_terms(queries, index.stemmed, index.tokenizer))
    is_phrase = F.contains("term", F.lit(" "))
    phrases = terms.filter(is_phrase).select("term").distinct()
    if phrases.isEmpty():
        weighted = kept(_weighted(index.terms, terms, index))
        return _pruned(index, weighted, k, kept) if prune else _matches(index, weighted)
    found = kept(phrase_postings(index, phrases))
    weighted = kept(_weighted(index.terms.unionByName(term_counts(found)), terms, index))
    if not prune:
        return _matches(index, weighted, phrases=found)
    # Phrases have no bands, so a query with one is scored in full.
    with_phrase = terms.filter(is_phrase).select("query_id").distinct()
    whole, others = (weighted.join(with_phrase, "query_id", how) for how in ("left_semi", "left_anti"))
    return _matches(index, whole, phrases=found).unionByName(_pruned(index, kept(others), k, kept))


def _corpus_facts(index: SearchIndex) -> Column:
    n_docs = F.col("n_docs")
    facts = index.corpus.select(n_docs, (F.col("n_tokens").cast("double") / n_docs).alias("avg_len"))
    if not index.buckets:
        return facts.select(F.struct("n_docs", "avg_len")).scalar()
    if index.facts is None:  # of a stored index one row is read; its segments are fixed
        index.facts = tuple(facts.first())
    return F.struct(F.lit(index.facts[0]).alias("n_docs"), F.lit(index.facts[1]).cast("double").alias("avg_len"))


def _weighted(counts: DataFrame, terms: DataFrame, index: SearchIndex) -> DataFrame:
    """The terms of queries with their weight; terms without a document are left out."""
    return terms.join(_term_weights(counts, terms.select("term"), _corpus_facts(index)), "term")


def _gain(tf: Column, length: Column, stats: Column) -> Column:
    return F.col("times") * F.col("idf") * tf * (K1 + 1) / (tf + K1 * (1 - B + B * length / stats["avg_len"]))


def _best(matches: DataFrame, k: int) -> DataFrame:
    return top_n_per_group(matches, ["query_id"], ["-score", "patent_id"], k)


def _matches(
    index: SearchIndex, weighted: DataFrame, bands: DataFrame | None = None, phrases: DataFrame | None = None
) -> DataFrame:
    """(query_id, patent_id, score) of all patents a query holds for, or of those in its ``bands`` (query_id, band)."""
    by_term, keys, stats = weighted, ["term"], _corpus_facts(index)
    postings = index.postings
    if bands is not None:
        by_term, keys = by_term.join(bands.select("query_id", "band"), "query_id"), ["band", *keys]
        stretches, few = _stretches_of(by_term)
        postings = postings.filter(stretches)
    if index.buckets:
        by_term, keys = by_term.withColumn("bucket", bucket_of(index.buckets)), ["bucket", *keys]
    hinted = if_small(by_term) if bands is None else F.broadcast(by_term) if few else by_term
    found = without_dead(postings.join(hinted, keys), index.dead)
    columns = [*weighted.columns, "patent_id", "tf", "doc_len"]
    found = found.select(columns)
    if phrases is not None:
        found = found.unionByName(phrases.join(weighted, "term").select(columns))
    gain = F.when(F.col("part") == 0, _gain(F.col("tf"), F.col("doc_len"), stats))
    hits = found.select(
        "query_id", "alt", "clause", "n_clauses", "part", "n_terms", "patent_id",
        F.coalesce(gain, F.lit(0.0)).alias("gain"),
    )
    by_part = (
        hits.repartition("query_id", "patent_id")
        .groupBy("query_id", "patent_id", "alt", "n_clauses", "clause", "part", "n_terms")
        .agg(F.count(F.lit(1)).alias("n_found"), F.sum("gain").alias("gain"))
        .withColumn("full", F.col("n_found") == F.col("n_terms"))
    )
    wanted_part, unwanted_part = F.col("part") == 0, F.col("part") > 0
    by_clause = by_part.groupBy("query_id", "patent_id", "alt", "n_clauses", "clause").agg(
        (
            F.bool_or(wanted_part & F.col("full")) & ~F.bool_or(unwanted_part & F.col("full"))
        ).alias("holds"),
        F.sum("gain").alias("gain"),
    )
    by_alt = by_clause.groupBy("query_id", "patent_id", "alt", "n_clauses").agg(
        F.count_if("holds").alias("n_holding"), F.sum("gain").alias("gain")
    )
    return (
        by_alt.filter(F.col("n_holding") == F.col("n_clauses"))
        .groupBy("query_id", "patent_id")
        .agg(F.round(F.sum("gain"), 6).alias("score"))
    )


def _stretches_of(by_term: DataFrame) -> tuple[Column, bool]:
    """For each term the bands from the first to the last one asked for, as a condition that Parquet can skip by, and
    whether ``by_term`` is small enough to broadcast.

    The condition only narrows what is read; the join decides. Terms of very many queries are left to the join alone.
    """
    spans = by_term.groupBy("term").agg(F.min("band"), F.max("band"), F.count(F.lit(1))).limit(MOST_SPANS + 1).collect()
    if len(spans) > MOST_SPANS:
        return F.lit(True), False
    condition = F.lit(False)
    for term, low, high, _ in spans:
        condition = condition | ((F.col("term") == term) & F.col("band").between(low, high))
    return condition, sum(rows for *_, rows in spans) <= MOST_HITS


def band_bounds(index: SearchIndex, weighted: DataFrame) -> DataFrame:
    """(query_id, band, bound, most): the highest score a document of a band can have, and how many can match at most.

    A band in which a wanted term does not occur is left out, where no other alternative can hold.
    """
    stats = _corpus_facts(index)
    wanted = weighted.filter("part = 0")
    blocks = index.blocks.join(if_small(wanted.select("term").distinct()), "term", "left_semi").groupBy("term", "band")
    blocks = blocks.agg(F.sum("n").alias("n"), F.max("max_tf").alias("max_tf"), F.min("min_len").alias("min_len"))
    each = wanted.join(blocks, "term").withColumn("bound", _gain(F.col("max_tf"), F.col("min_len"), stats))
    sums = [F.sum("bound").alias("bound"), F.min("n").alias("n"), F.count(F.lit(1)).alias("found")]
    clause = each.groupBy("query_id", "band", "alt", "n_clauses", "clause", "n_terms").agg(*sums)
    alt = clause.filter("found = n_terms").groupBy("query_id", "band", "alt", "n_clauses").agg(*sums)
    whole = alt.filter("found = n_clauses").groupBy("query_id", "band")
    return whole.agg(F.sum("bound").alias("bound"), F.sum("n").alias("most"))


def _first_bands(bands: DataFrame, k: int) -> DataFrame:
    """The bands of highest bound, until enough matches are possible; ``is_first`` marks them."""
    before = Window.partitionBy("query_id").orderBy(F.desc("bound"), "band").rowsBetween(Window.unboundedPreceding, -1)
    return bands.withColumn("is_first", F.coalesce(F.sum("most").over(before), F.lit(0)) < FIRST * k)


def _pruned(index: SearchIndex, weighted: DataFrame, k: int, kept: Keep) -> DataFrame:
    """Matches that hold the k best of each query.

    The bands that promise most are scored first. Of the others only those are read whose bound reaches the k-th score found so
    far (rounding and ties included), or all where fewer than k were found.
    """
    bands = kept(_first_bands(band_bounds(index, weighted), k))
    first = kept(_best(_matches(index, weighted, bands.filter("is_first")), k))
    left = kept(_left_bands(bands, first, k))
    return first if left.isEmpty() else first.unionByName(_matches(index, weighted, left))


def _left_bands(bands: DataFrame, first: DataFrame, k: int) -> DataFrame:
    least = first.groupBy("query_id").agg(F.min("score").alias("least"), F.count(F.lit(1)).alias("n"))
    reached = F.when(F.col("n") >= k, F.col("least") - ROUNDING).otherwise(F.lit(float("-inf")))
    others = bands.filter("NOT is_first").join(least, "query_id", "left")
    return others.filter(F.col("bound") >= F.coalesce(reached, F.lit(float("-inf"))))


def postings_read(index: SearchIndex, queries: DataFrame, k: int = 200) -> DataFrame:
    """(query_id, n, n_read): how many postings the terms of a query have, and how many its search scores."""
    weighted = written(_weighted(index.terms, query_terms(queries, index.stemmed, index.tokenizer), index), "search")
    bands = written(_first_bands(band_bounds(index, weighted), k), "search")
    first = written(_best(_matches(index, weighted, bands.filter("is_first")), k), "search")
    read = bands.filter("is_first").select("query_id", "band").union(_left_bands(bands, first, k).select("query_id", "band"))
    terms = weighted.select("query_id", "term").distinct()
    sizes = terms.join(index.blocks.groupBy("term", "band").agg(F.sum("n").alias("n")), "term")
    marked = sizes.join(read.withColumn("is_read", F.lit(True)), ["query_id", "band"], "left")
    n_read = F.sum(F.when(F.col("is_read"), F.col("n")).otherwise(F.lit(0)))
    return marked.groupBy("query_id").agg(F.sum("n").alias("n"), n_read.alias("n_read"))


def with_facts(hits: DataFrame, patents: DataFrame, most: int | None = None) -> DataFrame:
    """The found patents with their columns; patents are unique. ``most`` says how many hits there can be: a few are
    broadcast, otherwise Spark decides."""
    return patents.join(F.broadcast(hits) if most is not None and most <= MOST_HITS else hits, "patent_id")


# ---- titles -----------------------------------------------------------------------------------


@dataclass
class TitleIndex:
    """Titles by their grams: stretches of GRAM characters, and of two for queries of two. The empty gram has all."""

    grams: DataFrame  # gram, patent_id
    counts: DataFrame  # gram, n
    patents: DataFrame
    buckets: int = 0  # of a stored index: the grams are in folders by bucket


def _stretches(text: Column, length: int) -> Column:
    """The stretches of a text, each once. Its characters are cut by ``split``, which walks the text once; ``substr``
    would walk it up to every stretch."""
    characters = F.split(text, "")
    found = characters
    for at in range(2, length + 1):  # the lists' ends, which no character follows, are null and go
        found = F.zip_with(found, F.slice(characters, F.lit(at), F.greatest(F.size(characters), F.lit(0))), lambda a, b: F.concat(a, b))
    return F.array_distinct(F.filter(found, lambda x: x.isNotNull() & (F.length(x) == length)))


def title_grams(patents: DataFrame) -> DataFrame:
    """(gram, patent_id), each once for a title."""
    lowered = F.lower("title")
    grams = F.concat(F.array(F.lit("")), _stretches(lowered, 2), _stretches(lowered, GRAM))
    titled = patents.filter(F.col("title").isNotNull())
    return titled.select("patent_id", F.explode_outer(grams).alias("gram")).select("gram", "patent_id")


def scan_titles(patents: DataFrame) -> TitleIndex:
    """An index that is never stored: a search cuts all titles, and keeps the grams it asks for."""
    grams = title_grams(patents)
    return TitleIndex(grams, grams.groupBy("gram").agg(F.count(F.lit(1)).alias("n")), patents)


def _asked_grams(index: TitleIndex, queries: DataFrame) -> DataFrame:
    """(query_id, gram, n_asked): the rarest grams of each query's text, or of its parts between wildcards."""
    parts = F.col("parts")
    each = F.transform(parts, lambda part: F.when(F.length(part) == 2, F.array(part)).otherwise(_stretches(part, GRAM)))
    grams = F.array_distinct(F.flatten(each))
    listed = queries.select("query_id", F.explode(F.when(F.size(grams) > 0, grams).otherwise(F.array(F.lit("")))).alias("gram"))
    known = if_small(listed.select("gram").distinct())
    counts = index.counts
    if index.buckets:
        known, counts = known.withColumn("bucket", bucket_of(index.buckets, "gram")), index.counts
    counts = counts.join(known, [c for c in ("bucket", "gram") if c in counts.columns], "left_semi").select("gram", "n")
    sized = listed.join(counts, "gram", "left").withColumn("n", F.coalesce("n", F.lit(0)))
    rarest = top_n_per_group(sized, ["query_id"], ["n", "gram"], RAREST)
    return rarest.withColumn("n_asked", F.count(F.lit(1)).over(Window.partitionBy("query_id"))).drop("n")


def fallback_title(
    titles: TitleIndex, queries: DataFrame, k: int = 200, wildcards: bool = False
) -> DataFrame:
    """Titles that contain a query's raw text, latest year first: the columns of patents and query_id.

    The titles that have the rarest grams of a query are looked up, and those that have its text are kept. A query given
    twice is answered twice. ``wildcards`` lets ``%`` and ``_`` in the text match anything, as a LIKE pattern
    does; otherwise they stand for themselves. A pattern without two characters in a row is tested on all titles.
    """
    usable = queries.filter(F.length(F.trim("query")) >= MIN_QUERY_LENGTH)
    text = F.lower("query")
    parts = F.split(text, "[%_]") if wildcards else F.array(text)
    named = usable.select("query_id", text.alias("_text"), parts.alias("parts"))
    asked = _asked_grams(titles, named)
    keys = ["gram"]
    if titles.buckets:
        asked, keys = asked.withColumn("bucket", bucket_of(titles.buckets, "gram")), ["bucket", "gram"]
    found = titles.grams.join(if_small(asked), keys).groupBy("query_id", "patent_id", "n_asked")
    likely = found.agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") == F.col("n_asked")).select("query_id", "patent_id")
    tested = titles.patents.join(likely, "patent_id").join(named.drop("parts"), "query_id")
    lowered = F.lower("title")
    if wildcards:
        hit = F.like(lowered, F.concat(F.lit("%"), F.col("_text"), F.lit("%")))
    else:
        hit = F.contains(lowered, F.col("_text"))
    matched = tested.filter(hit).select(*titles.patents.columns, "query_id")
    return top_n_per_group(matched, ["query_id"], ["-year", "patent_id"], k)


def search_or_title(
    index: SearchIndex, titles: TitleIndex, queries: DataFrame, k: int = 200, wildcards: bool = False
) -> DataFrame:
    """(query_id, patent_id, score, found_by): ranked hits, and for queries the search cannot read the
    patents whose title has their text, without a score."""
    ranked = search(index, queries, k).withColumn("found_by", F.lit("text"))
    found = fallback_title(titles, malformed_queries(queries), k, wildcards)
    none = F.lit(None).cast("double").alias("score")
    return ranked.unionByName(found.select("query_id", "patent_id", none, F.lit("title").alias("found_by")))


# ---- declared lookups -------------------------------------------------------------------------


def title_prefix(patents: DataFrame, prefix: str) -> DataFrame:
    return patents.filter(F.col("title").startswith(prefix))


def name_lookup(
    entities: DataFrame,
    name: str | None = None,
    prefix: str | None = None,
    where: dict[str, str] | None = None,
) -> DataFrame:
    """Inventors or companies by exact name, name prefix and equal columns (country, type)."""
    if name is not None:
        entities = entities.filter(F.col("name") == name)
    if prefix is not None:
        entities = entities.filter(F.col("name").startswith(prefix))
    for column, value in (where or {}).items():
        entities = entities.filter(F.col(column) == value)
    return entities


def date_type_filter(
    patents: DataFrame, low=None, high=None, kind: str | None = None, by: str = "filing_date"
) -> DataFrame:
    """Patents in a date range and of a type; a filing date range also prunes year folders."""
    if low is not None:
        patents = patents.filter(F.col(by) >= F.lit(low))
    if high is not None:
        patents = patents.filter(F.col(by) <= F.lit(high))
    if by == "filing_date" and low is not None and high is not None:
        patents = patents.filter(F.col("year").between(low.year, high.year))
    return patents if kind is None else patents.filter(F.col("patent_type") == kind)


# ---- results ----------------------------------------------------------------------------------


def result_figures(results: DataFrame) -> DataFrame:
    """Hits, year range, mean claims and mean lag in years per query; NULLs are skipped."""
    return results.groupBy("query_id").agg(
        F.count(F.lit(1)).alias("hits"),
        F.min("year").alias("first_year"),
        F.max("year").alias("last_year"),
        F.round(F.avg("num_claims"), 4).alias("avg_claims"),
        F.round(F.avg("grant_lag_days") / DAYS_PER_YEAR, 4).alias("avg_lag_years"),
    )


def year_histogram(results: DataFrame) -> DataFrame:
    dated = results.filter(F.col("year").isNotNull())
    return (
        dated.groupBy("query_id", "year")
        .agg(F.count(F.lit(1)).alias("n"))
        .orderBy("query_id", "year")
    )


def result_table(results: DataFrame) -> DataFrame:
    return results.select("query_id", *RESULT_COLUMNS)


def first_abstracts(results: DataFrame, n: int = 10) -> DataFrame:
    listed = top_n_per_group(results, ["query_id"], ["-score", "patent_id"], n)
    return listed.select("query_id", "patent_id", "title", "abstract")


def export_results(results: DataFrame, queries: DataFrame, folder: str) -> None:
    """One folder of CSV per query, ``query_id=.../file=...``, where file is named after the query's text."""
    named = results.join(queries.withColumn("file", file_slug(F.col("query"))), "query_id")
    (
        named.select("query_id", "file", *RESULT_COLUMNS, "patent_date", "abstract")
        .write.mode("overwrite")
        .partitionBy("query_id", "file")
        .option("header", True)
        .option("escape", '"')
        .csv(folder)
    )
