"""Short results out of long ones."""

from pyspark.sql import functions as F

from grantlens.functions.ranking import top_n_per_group


def test_top_n_is_a_prefix_of_the_order(spark):
    frame = spark.range(1000).select((F.col("id") % 3).alias("g"), (F.col("id") * 7919 % 101).alias("v"), "id")
    all_rows = top_n_per_group(frame, ["g"], ["-v", "id"], 1000).collect()
    for n in (1, 5):
        few = top_n_per_group(frame.repartition(7), ["g"], ["-v", "id"], n).collect()
        for group in range(3):
            order = sorted((-r.v, r.id) for r in all_rows if r.g == group)
            assert sorted((-r.v, r.id) for r in few if r.g == group) == order[:n]
