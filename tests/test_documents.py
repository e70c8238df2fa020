"""The document-store writer: upserts by key, failed tasks, aborted jobs."""

import os

import pytest
from pyspark.sql import functions as F

from adpulse.session import work_dir
from adpulse.sources.documents import Target, read_documents, write_documents
from helpers import rows

SCHEMA = "id bigint, n bigint, at timestamp_ntz"


def docs(spark, n, value):
    return spark.range(n).select("id", (F.col("id") + value).alias("n"), F.lit("2024-01-02 03:04:05.678").cast("timestamp_ntz").alias("at"))


def folder(spark):
    return work_dir(spark, "t-documents").removeprefix("file:")


def test_last_document_of_a_key_counts(spark):
    path = folder(spark)
    write_documents(docs(spark, 100, 0).repartition(4), path, batch_rows=7)
    write_documents(docs(spark, 40, 1000).repartition(3), path)
    got = read_documents(spark, path, ["id"], SCHEMA)
    assert rows(got, "id", "n") == [(i, i + (1000 if i < 40 else 0)) for i in range(100)]
    assert str(got.first()["at"]) == "2024-01-02 03:04:05.678000"
    assert len(os.listdir(f"{path}/commits")) == 2


def test_an_aborted_job_leaves_nothing_and_a_retry_one_copy(spark):
    path = folder(spark)
    write_documents(docs(spark, 10, 0), path)
    before = sorted(os.listdir(f"{path}/parts"))
    bad = docs(spark, 50, 5).repartition(5, "id").withColumn("n", F.when(F.col("id") == 41, F.raise_error(F.lit("lost"))).otherwise(F.col("n")).cast("bigint"))
    with pytest.raises(Exception, match="lost"):
        write_documents(bad, path)
    assert rows(read_documents(spark, path, ["id"], SCHEMA), "id", "n") == [(i, i) for i in range(10)]
    write_documents(docs(spark, 50, 5), path)
    write_documents(docs(spark, 50, 5), path)
    assert rows(read_documents(spark, path, ["id"], SCHEMA), "id", "n") == [(i, i + 5) for i in range(50)]
    assert set(before) <= set(os.listdir(f"{path}/parts"))


def test_a_failing_session_drops_its_part(spark):
    path = folder(spark)

    def batches():
        yield [{"id": 1}]
        raise RuntimeError("connection lost")

    with pytest.raises(RuntimeError):
        Target(path).stage("p", batches())
    assert os.listdir(f"{path}/parts") == []


def test_empty_and_overwrite(spark):
    path = folder(spark)
    write_documents(docs(spark, 3, 0).where("id < 0"), path)
    write_documents(docs(spark, 3, 0), path)
    assert read_documents(spark, path, ["id"], SCHEMA).count() == 3
    with pytest.raises(Exception, match="append"):
        docs(spark, 1, 0).write.format("adpulse_documents").mode("overwrite").option("path", path).save()
