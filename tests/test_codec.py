import json

import pytest

from adpulse.sources import codec
from adpulse.sources.impressions import impressions_from_events
from adpulse.sources.tables import read_table
from helpers import SF_SMALL, rows

GOOD = {"timestamp": 1, "publisher": "publisher_1", "advertiser": "advertiser_0",
        "website": "website_1.com", "geo": "NY", "bid": 0.5, "cookie": "cookie_1"}


def _msgs(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "value string")


def _with(**kw):
    d = dict(GOOD)
    for k, v in kw.items():
        if v is ...:
            d.pop(k)
        else:
            d[k] = v
    return json.dumps(d)


MALFORMED = {
    "missing fields": '{"timestamp":1,"publisher":"p"}',
    "not json": "not json",
    "string in long": _with(timestamp="x"),
    "fraction in long": _with(timestamp=1.7),
    "string in double": _with(bid="0.5"),
    "null message": None,
    "number in string": _with(publisher=5),
    "object in string": _with(cookie={"x": 1}),
    "array in string": _with(geo=["NY"]),
    "boolean in string": _with(website=True),
    "text that names a number": _with(bid="NaN"),
    "number beyond doubles": _with(bid=0.5).replace("0.5", "1e999"),
    "null field": _with(cookie=None),
}


@pytest.mark.parametrize("case", sorted(MALFORMED))
def test_strict_decode_fails_the_query(spark, case):
    df = codec.decode_strict(_msgs(spark, json.dumps(GOOD), MALFORMED[case]))
    with pytest.raises(Exception):
        df.collect()


def test_strict_check_survives_column_pruning(spark):
    # only one field is used downstream; a message missing another field still fails
    df = codec.decode_strict(_msgs(spark, _with(cookie=...))).select("geo")
    with pytest.raises(Exception):
        df.collect()


def test_strict_decode_accepts_extra_fields(spark):
    out = codec.decode_strict(_msgs(spark, _with(extra=9))).collect()
    assert out[0].asDict() == GOOD


def test_permissive_reasons(spark):
    msgs = spark.createDataFrame(
        [("a", '{"timestamp":1,"publisher":"p"}'), ("b", "not json"), ("c", _with(timestamp="x")),
         ("d", _with(timestamp=1.7)), ("e", _with(bid="0.5")), ("f", _with(extra=9)),
         ("g", json.dumps(GOOD))], "key string, value string")
    dec = codec.decode_permissive(msgs, keep=("key",))
    got = dict(rows(dec, "key", "reject_reason"))
    assert got == {
        "a": "missing:advertiser,website,geo,bid,cookie",
        "b": "unparseable",
        "c": "invalid:timestamp",
        "d": "invalid:timestamp",
        "e": "invalid:bid",
        "f": None,
        "g": None,
    }
    assert codec.accepted(dec).count() == 2
    assert codec.rejects(dec).count() == 5


def test_roundtrip_is_identity(spark):
    imp = impressions_from_events(read_table(spark, SF_SMALL, "events"))
    back = codec.decode_strict(codec.encode_messages(imp))
    assert rows(back) == rows(imp)


def test_json_parsed_once(spark):
    dec = codec.rejects(codec.decode_permissive(_msgs(spark, "x")))
    plan = dec._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("parse_json") == 1 or plan.lower().count("parsejson") == 1


from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

_text = st.text(st.characters(blacklist_categories=("Cs",)), max_size=12)
_record = st.tuples(st.integers(-2**62, 2**62), _text, _text, _text, _text,
                    st.floats(allow_nan=False, allow_infinity=False, width=64), _text)


@settings(max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(_record, min_size=1, max_size=20))
def test_roundtrip_any_record(spark, records):
    df = spark.createDataFrame(records, "timestamp bigint, publisher string, advertiser string, website string, geo string, bid double, cookie string")
    back = codec.decode_strict(codec.encode_messages(df))
    assert rows(back) == rows(df)
