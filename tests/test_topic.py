"""How a table becomes a topic: even files and batches however it is split."""

from pyspark.sql import functions as F

from adpulse.plans import streams
from adpulse.session import work_dir
from adpulse.streaming import jobs, progress


def table_of(spark, name, rows=4000, files=1):
    """``events`` of five days, in the order of time in so many files."""
    base = work_dir(spark, name)
    at = F.timestamp_add("SECOND", F.col("id") * (5 * 86_400) / rows, F.expr("TIMESTAMP_NTZ'2024-01-01 00:00:00'"))
    events = spark.range(0, rows, 1, files).select(
        F.col("id").alias("event_id"), at.alias("ts"), (F.col("id") % 97).alias("user_id"), F.lit("view").alias("event_type"),
        (F.col("id") % 50 / 100).alias("value"), F.concat(F.lit('{"k": '), F.col("id") % 100, F.lit("}")).alias("props"))
    events.write.parquet(f"{base}/events.parquet")
    return base


def test_files_of_a_step_are_even(spark):
    base, parts = table_of(spark, "t-topic"), spark.sparkContext.defaultParallelism
    topic = spark.read.parquet(streams.topic_of(spark, base, "t-topic")).withColumn("file", F.input_file_name())
    files = topic.groupBy("file").agg(F.count(F.lit(1)).alias("n"), F.min("arrival").alias("low"), F.max("arrival").alias("high")).orderBy("low").collect()
    assert len(files) == streams.SLICES * parts
    assert sum(f.n for f in files) == 4000 == topic.select("key").distinct().count()
    assert max(f.n for f in files) <= 2 * 4000 / len(files)  # one core's share of a step, not the whole of it
    steps = [files[k:k + parts] for k in range(0, len(files), parts)]
    assert all(max(f.high for f in a) < min(f.low for f in b) for a, b in zip(steps, steps[1:]))


def test_a_step_is_a_batch_of_the_job(spark):
    base = table_of(spark, "t-steps", files=7)
    topic = streams.topic_of(spark, base, "t-steps")
    progress.logged(spark, f"{topic}-job", lambda: streams.start(streams.consume(spark, topic), f"{topic}-job"))
    log = progress.read_progress(spark, f"{topic}-job").select("batch", F.col("observed")["ingest.messages"].alias("n")).collect()
    assert len(log) == streams.SLICES and sum(r.n for r in log) == 4000
    assert max(r.n for r in log) <= 1.2 * 4000 / streams.SLICES
    assert jobs.read_partials(spark, f"{topic}-job").agg(F.sum("imps")).first()[0] == 4000


def test_small_batches_make_small_stages(spark):
    base = table_of(spark, "t-stages")
    topic, tracker = streams.topic_of(spark, base, "t-stages"), spark.sparkContext.statusTracker()
    with jobs.shuffle_partitions(spark, 200):
        query = streams.start(streams.consume(spark, topic), f"{topic}-job")
        query.awaitTermination()
    stages = {s for j in tracker.getJobIdsForGroup(str(query.runId)) for s in tracker.getJobInfo(j).stageIds}
    ran = [s.numTasks for s in map(tracker.getStageInfo, stages) if s is not None and s.numCompletedTasks]
    assert ran and max(ran) < 200  # the merged windows of a batch are cached in few partitions
    assert jobs.read_partials(spark, f"{topic}-job").agg(F.sum("imps")).first()[0] == 4000


def test_caching_leaves_the_session_as_it_was(spark):
    name = "spark.sql.optimizer.canChangeCachedPlanOutputPartitioning"
    before = spark.conf.get(name)
    with jobs.shuffle_partitions(spark, 200):
        sums = jobs.kept(spark.range(1000).groupBy((F.col("id") % 300).alias("k")).agg(F.sum("id").alias("s")))
        assert sums.agg(F.sum("s")).first()[0] == 999 * 500 and sums.rdd.getNumPartitions() < 200
    sums.unpersist()
    assert spark.conf.get(name) == before


def test_rows_without_a_time_are_not_published(spark):
    base = table_of(spark, "t-untimed", 200)
    arrived = streams.arrivals(spark, base).withColumn("arrival", F.when(F.col("event_id") % 10 != 0, F.col("arrival")))
    topic = streams.publish(arrived, f"{base}/topic")
    assert spark.read.parquet(topic).count() == 180
