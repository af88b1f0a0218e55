"""Mixing sources to target weights by systematic sampling, with DataFrame functions only.

Every document of a source has the same expected number of copies, ``target / source size``. The
documents of a source are put in one order, by size, so that each stretch of the order holds documents
of nearly equal size; the expected copies are summed along it from one random offset, and a document is
emitted once for each whole number that the sum passes.

The order is cut into chunks of (source, size class, share of doc_id). Only the counts of the chunks
are summed along a source; the running number inside a chunk comes from a window over that chunk. No
task sees a whole source, however much of the data it holds.
"""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

WORDS = r"[^\x20\x09-\x0D]+"
SHARES = 64  # parts of a (source, size class), so that equal sizes do not meet in one task


def word_count(text: Column) -> Column:
    """Words between ASCII white space; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORDS)), F.lit(0)).cast("long")


def offset_of(source: Column, seed: int) -> Column:
    """A number in [0, 1) that depends on the source and the seed alone."""
    digest = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(source, F.lit(""))).cast("binary"))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("double") / F.lit(2.0**32)


def source_targets(
    sizes: DataFrame, weights: Sequence[int], percent: int, most: int
) -> DataFrame:
    """(_mix_source, source_size, target) from (_mix_source, source_size), one row per source.

    Sources in code point order, null last, get the weights in turn. The wanted total is ``percent``
    of all sizes. A target stops at ``most`` times its source's size and what it leaves is shared
    again: in the order of size over weight, a source is full if its share of what the sources before
    it leave is not below its limit. All products are of whole numbers, exact up to 38 digits.
    """
    whole = lambda c: c.cast("decimal(38,0)")
    everything = Window.partitionBy(F.lit(0))
    cycle = F.array(*[F.lit(w) for w in weights])
    place = F.row_number().over(everything.orderBy(F.col("_mix_source").asc_nulls_last()))
    ranked = sizes.select(
        "*",
        F.element_at(cycle, (place - 1) % len(weights) + 1).alias("_w"),
        F.sum("source_size").over(everything).alias("_all"),
    ).withColumn("_limit", F.col("source_size") * most)
    ascending = everything.orderBy(F.col("_limit") / F.col("_w"), F.col("_mix_source").asc_nulls_last())
    before = ascending.rowsBetween(Window.unboundedPreceding, -1)
    after = ascending.rowsBetween(0, Window.unboundedFollowing)
    shared = ranked.select(
        "*",
        (F.col("_all") * percent - F.coalesce(F.sum("_limit").over(before), F.lit(0)) * 100).alias("_left"),
        F.sum("_w").over(after).alias("_weights"),
    ).withColumn(
        "_full",
        whole(F.col("_limit")) * whole(F.col("_weights") * 100) <= whole(F.col("_left")) * whole(F.col("_w")),
    )
    # The first source that is not full, and with it all later ones, share what is left there.
    first = F.when(~F.col("_full"), F.struct("_left", "_weights"))
    rest = F.first(first, ignorenulls=True).over(
        ascending.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    )
    return shared.withColumn("_rest", rest).select(
        "_mix_source",
        "source_size",
        F.when(F.col("_full"), F.col("_limit").cast("double"))
        .otherwise(
            (F.col("_rest._left") * F.col("_w")).cast("double")
            / (F.col("_rest._weights") * 100).cast("double")
        )
        .alias("target"),
    )


def mix(
    documents: DataFrame,
    weights: Sequence[int] = (3, 1, 2),
    percent: int = 150,
    most: int = 2,
    seed: int = 17,
    doc_id: str = "doc_id",
    text: str = "text",
    source: str = "source",
    size: str | None = None,
) -> DataFrame:
    """All rows with ``_mix_size``, ``_mix_source_size``, ``_mix_target`` and ``_mix_copies``.

    ``_mix_copies`` (0 to ``most``) says how often the mix holds the row. Null text has size 0; null is
    a source of its own; a source of size 0 has target 0. Rows that repeat are documents of their own;
    which of two rows equal in doc_id, source and size is taken does not change the result's rows as
    far as these columns go. A null doc_id is ordered first. Other columns are kept whatever their
    names, as long as they do not start with ``_mix_``. ``size`` names a column of whole numbers from 0 that has the sizes
    already; then ``text`` is not read, and without it each text is worked through twice. Two runs give the same rows.
    """
    counted = F.col(size).cast("long") if size else word_count(F.col(text))
    sized = documents.withColumns(
        {
            "_mix_size": counted,
            "_mix_key": F.concat(F.when(F.col(source).isNull(), "-").otherwise("+"), F.coalesce(source, F.lit(""))),
            "_mix_share": F.coalesce(F.pmod(F.col(doc_id), F.lit(SHARES)), F.lit(0)).cast("int"),
        }
    ).withColumn("_mix_class", F.floor(F.sqrt(F.col("_mix_size"))))
    chunk = ["_mix_key", "_mix_class", "_mix_share"]
    counts = sized.groupBy(*chunk).agg(
        F.first(source).alias("_mix_source"),
        F.count(F.lit(1)).alias("_mix_n"),
        F.sum("_mix_size").alias("_mix_sum"),
    )
    sources = source_targets(
        counts.groupBy("_mix_key")
        .agg(F.first("_mix_source").alias("_mix_source"), F.sum("_mix_sum").alias("source_size"))
        .drop("_mix_key"),
        weights,
        percent,
        most,
    )
    along = Window.partitionBy("_mix_key").orderBy("_mix_class", "_mix_share")
    starts = counts.select(
        *chunk,
        "_mix_source",
        (F.sum("_mix_n").over(along) - F.col("_mix_n")).alias("_mix_start"),
    )
    starts = starts.join(
        sources.withColumnRenamed("_mix_source", "_mix_of"),
        F.col("_mix_source").eqNullSafe(F.col("_mix_of")),
    ).select(
        *chunk,
        "_mix_start",
        F.col("source_size").alias("_mix_source_size"),
        F.col("target").alias("_mix_target"),
        F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size"))
        .otherwise(0.0)
        .alias("_mix_rate"),
        offset_of(F.col("_mix_source"), seed).alias("_mix_offset"),
    )
    inside = Window.partitionBy(*chunk).orderBy("_mix_size", F.col(doc_id).asc_nulls_first())
    place = F.col("_mix_start") + F.row_number().over(inside)
    passed = lambda k: F.floor(F.col("_mix_rate") * k + F.col("_mix_offset"))
    placed = sized.join(starts, chunk).withColumn("_mix_place", place)
    copies = F.least(passed(F.col("_mix_place")) - passed(F.col("_mix_place") - 1), F.lit(most))
    return placed.select(
        *[F.col(f"`{c}`") for c in documents.columns],
        "_mix_size",
        "_mix_source_size",
        "_mix_target",
        copies.cast("int").alias("_mix_copies"),
    )


def mixed(documents: DataFrame, **options) -> DataFrame:
    """The mix itself: every row as often as ``_mix_copies`` says, with the columns of ``documents``."""
    repeated = mix(documents, **options).withColumn(
        "_mix_copies", F.explode(F.array_repeat(F.lit(0), F.col("_mix_copies")))
    )
    return repeated.select(*[F.col(f"`{c}`") for c in documents.columns])
