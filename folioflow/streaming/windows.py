"""Structured Streaming forms of the incremental operators."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.tables import scratch, table


def _run(stream: DataFrame, spark: SparkSession, name: str, merge) -> str:
    """Processes all that is there in micro-batches and stops; returns the folder of the result. Each batch has a folder
    of its own, which a repeated batch replaces."""
    out, state = scratch(spark, name), scratch(spark, f"{name}-state")
    query = stream.writeStream.foreachBatch(lambda df, i: merge(df, i, out)).option("checkpointLocation", state).outputMode("append").trigger(availableNow=True).start()
    query.awaitTermination()
    return out


def events_stream(spark: SparkSession, folder: str) -> DataFrame:
    schema = table(spark, folder, "events").schema
    return spark.readStream.schema(schema).parquet(f"{folder}/event[s].parquet")


def tumbling_counts(spark: SparkSession, folder: str, width: str = "1 day") -> DataFrame:
    """Events a day and type: batches are pre-aggregated and added up when read, so late rows count and no state is kept."""
    stream = events_stream(spark, folder).withColumn("at", F.col("ts").cast("timestamp"))

    def merge(df, i, out):
        df.groupBy(F.window("at", width)["start"].alias("start"), "event_type").agg(F.count("*").alias("n")).write.mode("overwrite").parquet(f"{out}/batch={i}")

    got = spark.read.parquet(_run(stream, spark, "tumbling", merge))
    return got.groupBy(F.date_format("start", "yyyy-MM-dd").alias("day"), "event_type").agg(F.sum("n").alias("n"))


def first_of_each(spark: SparkSession, folder: str, delay: str = "60 days") -> DataFrame:
    """Contents by their first event in the stream, told by a hash: state is kept for `delay` of event time, in which a
    content that comes again is dropped."""
    content = F.sha2(F.concat_ws(":", "event_type", F.col("user_id").cast("string")), 256).alias("digest")
    stream = events_stream(spark, folder).select(F.col("ts").cast("timestamp").alias("at"), content).withWatermark("at", delay).dropDuplicatesWithinWatermark(["digest"])
    got = spark.read.parquet(_run(stream, spark, "first", lambda df, i, out: df.write.mode("overwrite").parquet(f"{out}/batch={i}")))
    return got.select("digest")


def replayed(spark: SparkSession, folder: str) -> DataFrame:
    """Events replayed by their logical date, a day a batch and one after the other; a day that is run again replaces its
    own result. (day, run, n, total): run is the place of the day's batch."""
    days = scratch(spark, "days")
    dated = table(spark, folder, "events").withColumn("day", F.date_format(F.col("ts").cast("timestamp"), "yyyy-MM-dd"))
    dated.write.partitionBy("day").parquet(days)
    out, state, seen = scratch(spark, "replayed"), scratch(spark, "replayed-state"), []
    for day in sorted(r[0] for r in dated.select("day").distinct().collect()):  # logical dates: one run each, as a schedule has them
        source = spark.readStream.schema(table(spark, folder, "events").schema).parquet(f"{days}/day={day}")
        at = len(seen)
        seen.append(day)

        def run(df, i, day=day, at=at):
            one = df.agg(F.count("*").alias("n"), F.round(F.sum("value"), 4).alias("total"))
            one.select(F.lit(at).alias("run"), "n", "total").write.mode("overwrite").parquet(f"{out}/day={day}")

        source.writeStream.foreachBatch(run).option("checkpointLocation", f"{state}/{day}").trigger(availableNow=True).start().awaitTermination()
    return spark.read.schema("run int, n bigint, total double, day string").parquet(out).select("day", "run", "n", "total")


def sliding_counts(spark: SparkSession, folder: str, width: str = "6 hours", slide: str = "1 hour") -> DataFrame:
    """Events in overlapping windows, by a stateful aggregation in update mode: each batch writes the windows it
    changed, and of those the last count holds."""
    source = events_stream(spark, folder).select(F.col("ts").cast("timestamp").alias("at"), "event_type").withWatermark("at", "1 hour")
    counts = source.groupBy(F.window("at", width, slide), "event_type").agg(F.count("*").alias("n")).select(F.col("window.start").alias("start"), "event_type", "n")
    out, state = scratch(spark, "sliding"), scratch(spark, "sliding-state")

    def write(df, i):
        df.write.mode("overwrite").parquet(f"{out}/batch={i}")

    counts.writeStream.foreachBatch(write).outputMode("update").option("checkpointLocation", state).trigger(availableNow=True).start().awaitTermination()
    got = spark.read.parquet(out)
    return got.groupBy(F.date_format("start", "yyyy-MM-dd HH:mm").alias("start"), "event_type").agg(F.max_by("n", "batch").alias("n"))


def landed_then_scored(spark: SparkSession, folder: str) -> DataFrame:
    """Two streams in a row: the first lands events by day, the second starts on what it wrote and counts errors a day.
    A batch that is written again after a loss replaces its own folder, so nothing counts twice."""
    out, state = scratch(spark, "landed"), scratch(spark, "landed-state")
    land = events_stream(spark, folder).select("event_id", "event_type", F.date_format(F.col("ts").cast("timestamp"), "yyyy-MM-dd").alias("day"))
    land.writeStream.foreachBatch(lambda df, i: df.write.mode("overwrite").parquet(f"{out}/batch={i}")).option("checkpointLocation", state).trigger(availableNow=True).start().awaitTermination()
    schema = "event_id bigint, event_type string, day string, batch int"
    scored, state = scratch(spark, "scored"), scratch(spark, "scored-state")
    second = spark.readStream.schema(schema).parquet(out)

    def score(df, i):
        df.groupBy("day").agg(F.count("*").alias("n"), F.count_if(F.col("event_type") == "error").alias("errors")).write.mode("overwrite").parquet(f"{scored}/part={i}")

    second.writeStream.foreachBatch(score).option("checkpointLocation", state).trigger(availableNow=True).start().awaitTermination()
    return spark.read.parquet(scored).groupBy("day").agg(F.sum("n").alias("n"), F.sum("errors").alias("errors"))
