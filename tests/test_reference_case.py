"""The reference's own unit test: a (key, count) list grouped by key and summed."""

from adpulse.operators.metrics import sum_by_key


# The pairs and sums of the reference's test.
def test_convert_list_to_map(spark):
    raw = spark.createDataFrame(
        [("CO", 123), ("UT", 123), ("CO", 123), ("AZ", 123), ("CO", 123), ("UT", 123)],
        "key string, count int")
    got = {r["key"]: r["count"] for r in sum_by_key(raw).collect()}
    assert got == {"CO": 369, "UT": 246, "AZ": 123}
