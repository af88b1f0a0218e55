"""Test passages in training texts, by a positional inverted index kept as a table.

The index has one row for each word of a document: (row, term, pos), where ``row`` numbers the documents' rows. A
task writes the postings of its own documents, sorted by term, so building an index shuffles nothing. Each
document also has a row with an empty term, which carries its id and number of words.

A window of words is found by its terms' lists, from the rarest on: the occurrences of the rarest term say where the
window would start; the list of the second rarest, moved by its offset, is intersected with these starts; what
is left is intersected with the lists of all other terms. Only lists of the terms needed are read, and a list is never
gathered: every step is a join of tables on (row, position). Near matches start in the same way and
accept the terms in any order within a stretch of words.

Everything is DataFrame functions.
"""

import string
from contextlib import ExitStack

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from grantlens.sources.storage import delete_path, shared_folder, written, written_while

WIDTH = 10
#: What lies between words: ASCII without letters and digits.
SEPARATORS = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
BROADCAST_BYTES = 16_000_000
ALL = 2**31 - 1


def _split(text: Column) -> Column:
    """The words with A-Z in lower case, and an empty one before a leading and after a trailing separator.

    ``split`` is used as it walks the text once; ``regexp_extract_all`` copies the text for every match.
    """
    text = F.coalesce(text, F.lit(""))
    folded = F.translate(text, string.ascii_uppercase, string.ascii_lowercase)
    return F.split(F.when(F.octet_length(text) == F.length(text), F.lower(text)).otherwise(folded), SEPARATORS)


def words_of(text: Column) -> Column:
    return F.filter(_split(text), lambda word: word != "")


def _small(frame: DataFrame) -> DataFrame:
    """The frame with a hint to broadcast it if its measured size allows that; else Spark decides."""
    size = sum((F.octet_length(c) if kind == "string" else F.lit(64) for c, kind in frame.dtypes), F.lit(32))
    total = frame.agg(F.coalesce(F.sum(size), F.lit(0))).first()[0]
    return F.broadcast(frame) if total <= BROADCAST_BYTES else frame


def write_postings(documents: DataFrame, folder: str, terms: DataFrame | None = None, doc_id: str = "doc_id", text: str = "text") -> None:
    """Writes the index of ``documents`` to a folder; with ``terms`` (one column, term) of these words alone.

    Every row is a document of its own, whatever its id. A null text has no words.
    """
    words = documents.select(
        F.monotonically_increasing_id().alias("row"), F.col(doc_id).cast("long").alias("doc_id"), _split(F.col(text)).alias("_words")
    )
    leads = (F.element_at("_words", 1) == "").cast("int")
    ends = (F.element_at("_words", -1) == "").cast("int")
    placed = words.select(
        "row",
        "doc_id",
        F.greatest(F.size("_words") - leads - ends, F.lit(0)).cast("long").alias("n_words"),
        leads.alias("_leads"),
        F.posexplode(F.concat(F.array(F.lit("")), F.col("_words"))).alias("_at", "term"),
    ).filter("_at = 0 OR term <> ''")
    if terms is not None:
        asked = terms.select("term").unionByName(terms.sparkSession.range(1).select(F.lit("").alias("term")))
        placed = placed.join(_small(asked), "term", "left_semi")
    heads = F.col("_at") == 0
    rows = placed.select(
        "row",
        "term",
        (F.col("_at") - 1 - F.col("_leads")).alias("pos"),
        F.when(heads, F.col("doc_id")).alias("doc_id"),
        F.when(heads, F.col("n_words")).alias("n_words"),
    )
    rows.sortWithinPartitions("term", "row").write.parquet(f"{folder}/postings")


def read_postings(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.schema("row long, term string, pos int, doc_id long, n_words long").parquet(f"{folder}/postings")


def lists_of(postings: DataFrame) -> DataFrame:
    return postings.filter("term <> ''").select("row", "term", "pos")


def documents_of(postings: DataFrame) -> DataFrame:
    return postings.filter("term = ''").select("row", "doc_id", "n_words")


def item_windows(items: DataFrame, width: int = WIDTH, item_id: str = "item_id", text: str = "text") -> DataFrame:
    """(item, words): the distinct stretches of ``width`` words of each item; all its words where it has fewer."""
    words = items.select(F.col(item_id).alias("item"), words_of(F.col(text)).alias("_words")).filter(F.size("_words") > 0)
    starts = F.sequence(F.lit(1), F.greatest(F.size("_words") - width + 1, F.lit(1)))
    cut = F.transform(starts, lambda at: F.slice("_words", at, width))
    return words.select("item", F.explode(cut).alias("words")).distinct()


def _by_rarity(windows: DataFrame, lists: DataFrame) -> DataFrame:
    """(window, item, width, terms) with terms (hits, offset, term) from the rarest on; windows with a term that the
    index lacks are left out."""
    hits = lists.groupBy("term").agg(F.count(F.lit(1)).alias("hits"))
    numbered = windows.select(F.monotonically_increasing_id().alias("window"), "item", "words")
    terms = numbered.select("window", "item", F.size("words").alias("width"), F.posexplode("words").alias("offset", "term"))
    ranked = terms.join(hits, "term").groupBy("window", "item", "width")
    sorted_terms = F.sort_array(F.collect_list(F.struct("hits", "offset", "term")))  # at most the window's width
    return ranked.agg(sorted_terms.alias("terms")).filter(F.size("terms") == F.col("width"))


def _first_two(windows: DataFrame) -> DataFrame:
    first, second = F.get("terms", F.lit(0)), F.get("terms", F.lit(1))
    names = [first["term"].alias("term"), first["offset"].alias("offset"), second["term"].alias("term2"), second["offset"].alias("offset2")]
    return windows.select("window", "width", *names)


def find_phrases(postings: DataFrame, windows: DataFrame, kept) -> DataFrame:
    """(row, start, width, item): every place where the words of a window follow each other.

    ``windows`` is as ``item_windows`` gives it. ``kept(frame, purpose)`` stores a table for several readings.
    """
    lists = lists_of(postings)
    ranked = kept(_by_rarity(windows, lists), "windows")
    first = lists.join(_small(_first_two(ranked)), "term")
    starts = first.select("row", (F.col("pos") - F.col("offset")).alias("start"), "window", "width", "term2", "offset2")
    starts = kept(starts, "starts")
    one_word = starts.filter("width = 1")
    seconds = _first_two(ranked).select(F.col("term2").alias("term")).filter("term IS NOT NULL").distinct()
    second = lists.join(_small(seconds), "term", "left_semi")
    moved = starts.filter("width > 1").withColumns({"pos": F.col("start") + F.col("offset2"), "term": F.col("term2")})
    both = kept(moved.join(second, ["row", "pos", "term"]).select("row", "start", "window", "width"), "pairs")
    others = _small(ranked.filter("width > 2").select("window", F.slice("terms", 3, ALL).alias("others")))
    asked = both.join(others, "window").select("row", "start", "window", "width", F.inline("others"))
    asked = asked.withColumn("pos", F.col("start") + F.col("offset"))
    near = lists.join(_small(both.filter("width > 2").select("row").distinct()), "row", "left_semi")
    whole = asked.join(near, ["row", "pos", "term"]).groupBy("row", "start", "window", "width")
    whole = whole.agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") == F.col("width") - 2)
    place = ["row", "start", "window", "width"]
    found = one_word.select(*place).unionByName(both.filter("width = 2")).unionByName(whole.select(*place))
    return found.join(ranked.select("window", "item"), "window").select("row", "start", "width", "item")


def find_near(postings: DataFrame, windows: DataFrame, span: int, kept) -> DataFrame:
    """(row, item, words, start, stop): windows all of whose different words occur within ``span`` words, in any order.

    One row for each occurrence of the window's rarest word that lies in such a stretch: the shortest one that holds
    it, of equal ones the leftmost; ``stop`` is its last word. A place has at most 2 * span words to look at.
    """
    lists = lists_of(postings).withColumn("block", F.floor(F.col("pos") / span))
    sets = windows.select("item", "words", F.array_distinct("words").alias("_set"))
    ranked = kept(_by_rarity(sets.select(F.struct("item", "words").alias("item"), F.col("_set").alias("words")), lists), "windows")
    anchors = lists.join(_small(_first_two(ranked).select("window", "term")), "term").select("window", "row", F.col("pos").alias("anchor"))
    anchors = kept(anchors, "anchors")
    names = _small(ranked.select("window", F.explode("terms.term").alias("term"), "width"))
    blocks = F.explode(F.array(*[F.floor(F.col("anchor") / span) + k for k in (-1, 0, 1)])).alias("block")
    rows = lists.join(_small(anchors.select("row").distinct()), "row", "left_semi")
    around = anchors.select("window", "row", "anchor", blocks).join(names, "window").join(rows, ["row", "block", "term"])
    around = around.filter(F.abs(F.col("pos") - F.col("anchor")) < span).groupBy("window", "row", "anchor", "width")
    near = around.agg(F.collect_list(F.struct("pos", "term")).alias("near")).filter(
        F.size(F.array_distinct("near.term")) == F.col("width")
    )
    near = near.join(ranked.select("window", "item", F.col("terms.term").alias("terms")), "window")

    def stretch(start: Column) -> Column:
        def first_at(term: Column) -> Column:
            later = F.filter("near", lambda x: (x["term"] == term) & (x["pos"] >= start))
            return F.array_min(F.transform(later, lambda x: x["pos"]))

        ends = F.transform("terms", first_at)
        stop = F.when(~F.exists(ends, lambda x: x.isNull()), F.greatest(F.array_max(ends), "anchor"))
        return F.struct((stop - start).alias("length"), start.alias("start"), stop.alias("stop"))

    starts = F.filter(F.array_distinct("near.pos"), lambda at: at <= F.col("anchor"))
    stretches = F.filter(F.transform(starts, stretch), lambda x: x["length"] < span)
    best = near.withColumn("_best", F.array_min(stretches)).filter("_best IS NOT NULL")
    return best.select("row", "item.item", "item.words", "_best.start", "_best.stop")


def _covered(found: DataFrame) -> DataFrame:
    """(row, n_hit): how many positions the stretches of a document cover, each counted once."""
    longest = found.groupBy("row", "start").agg(F.max("width").alias("width"))
    before = Window.partitionBy("row").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    end = F.col("start") + F.col("width")
    seen = F.coalesce(F.max(end).over(before), F.lit(0))
    new = longest.select("row", F.greatest(end - F.greatest(F.col("start"), seen), F.lit(0)).alias("new"))
    return new.groupBy("row").agg(F.sum("new").cast("long").alias("n_hit"))


def contamination(
    documents: DataFrame, benchmark: DataFrame, width: int = WIDTH, doc_id: str = "doc_id", text: str = "text",
    item_id: str = "item_id", item_text: str = "text",
) -> DataFrame:
    """(doc_id, n_words, n_hit, n_items, items_sha256, contaminated), one row for each row of ``documents``.

    Words are what stands between ASCII characters other than letters and digits, with A-Z lower-cased. A document
    word is hit if it lies in an occurrence of ``width`` consecutive words of an item, or of all words of a
    shorter item. Items without words (null texts too) match nothing; items with the same id count once, and items
    without an id are one item, whose id reads ''. Documents with null or empty texts have no words; rows that
    repeat, and null ids, are documents like any other. Only the named columns are read. Empty tables give no rows
    or no hits. Intermediate tables, the index among them, are deleted.
    """
    spark = documents.sparkSession
    place = shared_folder(spark, "positional-index")
    with ExitStack() as tables:
        kept = lambda frame, purpose: tables.enter_context(written_while(frame, purpose))
        tables.callback(delete_path, spark, place)
        windows = kept(item_windows(benchmark, width, item_id, item_text), "item-windows")
        terms = kept(windows.select(F.explode("words").alias("term")).distinct(), "item-terms")
        write_postings(documents, place, terms, doc_id, text)
        postings = read_postings(spark, place)
        found = kept(find_phrases(postings, windows, kept), "phrases")
        named = found.select("row", F.coalesce(F.col("item").cast("string"), F.lit("")).alias("item")).distinct()
        items = named.groupBy("row").agg(F.sort_array(F.collect_list("item")).alias("items"))
        joined = documents_of(postings).join(_covered(found), "row", "left").join(items, "row", "left")
        n_hit, items = F.coalesce("n_hit", F.lit(0).cast("long")), F.coalesce("items", F.array().cast("array<string>"))
        return written(
            joined.select(
                "doc_id",
                "n_words",
                n_hit.alias("n_hit"),
                F.size(items).cast("long").alias("n_items"),
                F.sha2(F.array_join(items, ","), 256).alias("items_sha256"),
                (n_hit > 0).alias("contaminated"),
            ),
            "contamination",
        )
