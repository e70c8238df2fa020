import hashlib
from collections import defaultdict

from pyspark.sql import functions as F

from adpulse.llm import exact_dedup


def expected(rows):
    groups = defaultdict(list)
    for i, t in rows:
        groups[t or ""].append(i)
    return {(i, t): (max((x for x in groups[t or ""] if x is not None), default=None), len(groups[t or ""]),
                     hashlib.sha256((t or "").encode()).hexdigest()) for i, t in rows}


def check(df, **options):
    rows = [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]
    out = exact_dedup.exact_dedup(df, **options).collect()
    want = expected(rows)
    assert sorted(map(str, rows)) == sorted(str((r.doc_id, r.text)) for r in out)
    stays = defaultdict(int)
    for r in out:
        assert (r.keep_id, r.group_size, r.text_sha256) == want[(r.doc_id, r.text)]
        stays[r.text_sha256] += r.kept
        assert not r.kept or r.doc_id == r.keep_id
    assert set(stays.values()) <= {1}


def test_groups_of_odd_rows(odd):
    check(odd)


def test_poor_hash_and_small_buckets_change_nothing(spark, odd):
    docs = spark.range(500).select(F.col("id").alias("doc_id"), F.concat(F.lit("t"), F.col("id") % 137).alias("text"))
    check(docs, capacity=4)
    check(docs, capacity=4, hash_of=lambda text: F.crc32(text) % 3)


def test_empty_table(none):
    assert exact_dedup.exact_dedup(none).count() == 0
    assert exact_dedup.without_copies(none).count() == 0


def test_rows_that_stay_keep_their_columns(odd):
    out = exact_dedup.without_copies(odd)
    assert out.columns == odd.columns
    assert out.count() == len({r.text or "" for r in odd.collect()})


def test_directory_covers_all_hashes_and_splits_overfull_buckets(spark):
    keys = spark.range(3000).select(F.xxhash64("id").alias("h"))
    slots, depth = exact_dedup.build_directory(keys, 3000, 50)
    rows = slots.collect()
    assert len({r.slot for r in rows}) == len(rows) and max(r.local_depth for r in rows) == depth
    fill = (keys.withColumn("slot", exact_dedup._prefix(F.col("h"), depth)).join(slots, "slot").groupBy("bucket").count())
    assert fill.agg(F.sum("count"), F.max("count")).first()[0] == 3000
    assert fill.agg(F.max("count")).first()[0] <= 50
