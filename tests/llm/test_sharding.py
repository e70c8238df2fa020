from collections import Counter

from pyspark.sql import functions as F

from adpulse.llm import sharding


def check_places(out, n_shards):
    rows = out.select("shard", "slot").collect()
    slots = {}
    for r in rows:
        slots.setdefault(r.shard, []).append(r.slot)
    sizes = [len(slots.get(s, [])) for s in range(n_shards)]
    assert sum(sizes) == len(rows) and max(sizes) - min(sizes) <= 1
    assert all(sorted(v) == list(range(len(v))) for v in slots.values())


def test_exact_sizes_and_gapless_slots(spark):
    docs = spark.range(5003).select(F.col("id").alias("doc_id"), F.concat(F.lit("text "), "id").alias("text")).repartition(11)
    out = sharding.shuffle_into_shards(docs, 24)
    check_places(out, 24)
    assert out.select("doc_id").distinct().count() == 5003


def test_every_row_keeps_its_columns(odd):
    out = sharding.shuffle_into_shards(odd, 4)
    check_places(out, 4)
    rest = [c for c in odd.columns if c != "shard"]
    assert Counter(map(tuple, out.select(rest).collect())) == Counter(map(tuple, odd.select(rest).collect()))


def test_empty_table_and_more_shards_than_rows(none, odd):
    assert sharding.shuffle_into_shards(none, 5).count() == 0
    check_places(sharding.shuffle_into_shards(odd, 50), 50)


def test_draws_follow_the_hypergeometric_law(spark):
    total, marked, drawn, n = 50, 20, 10, 20_000
    x = sharding.hypergeometric(F.lit(total).cast("long"), F.lit(marked).cast("long"), F.lit(drawn).cast("long"), F.col("id"))
    seen = {r.x: r["count"] for r in spark.range(n).select(x.alias("x")).groupBy("x").count().collect()}
    from math import comb
    for k in range(drawn + 1):
        p = comb(marked, k) * comb(total - marked, drawn - k) / comb(total, drawn)
        assert abs(seen.get(k, 0) - n * p) <= 5 * (n * p * (1 - p)) ** 0.5 + 1


def test_matrix_has_exact_margins(spark):
    sizes = [0, 1, 7, 1000, 13, 400, 2]
    counts = spark.createDataFrame([(i, n) for i, n in enumerate(sizes)], "pid long, n long")
    rows = sharding.communication_matrix(counts, len(sizes), sum(sizes), 5, 3).collect()
    assert {r.pid: r.upto[-1] for r in rows} == dict(enumerate(sizes))
    cells = [[b - a for a, b in zip([0, *r.upto], r.upto)] for r in rows]
    assert all(x >= 0 for row in cells for x in row)
    columns = [sum(c) for c in zip(*cells)]
    assert sum(columns) == sum(sizes) and max(columns) - min(columns) <= 1
