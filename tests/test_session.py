from pyspark.sql import functions as F

from orderflow.session import pin, unpin


def size_bits(df):
    return int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()).bit_length()


def test_a_loop_that_joins_its_own_aggregates_keeps_its_size(spark):
    """A checkpoint keeps the estimate, which squares itself each round."""
    now = pin(spark.range(20).select("id", (F.col("id") % 3).alias("k"), F.lit(1.0).alias("w")))
    for _ in range(12):
        before, sums = now, now.groupBy("k").agg(F.sum("w").alias("s"))
        now = pin(now.join(sums, "k").select("id", "k", (F.col("w") / F.col("s")).alias("w")))
        unpin(before)
    assert size_bits(now) < 24
    assert now.agg(F.round(F.sum("w"), 9)).first()[0] == 3.0


def test_pinned_rows_stay_and_unpinned_files_go(spark):
    made = spark.createDataFrame([(1, None), (2, [1.5])], "a long, b array<double>")
    kept = pin(made.withColumn("r", F.rand()))
    assert kept.orderBy("a").collect() == kept.orderBy("a").collect()
    assert [(r.a, r.b) for r in kept.orderBy("a").collect()] == [(1, None), (2, [1.5])]
    assert pin(made.limit(0)).count() == 0
    files = kept.inputFiles()
    unpin(kept)
    unpin(kept)
    assert files and not spark._jvm.java.io.File(files[0].removeprefix("file:")).exists()
