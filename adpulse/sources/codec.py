"""JSON message codec for impressions.

* ``encode_messages``: record -> compact JSON text (``value``), as a producer sends it.
* ``decode_strict``: the reference behaviour - any malformed message fails the
  job: broken JSON, a missing field, or a field of another JSON type (a number
  or an object where a string belongs, text where a number belongs).
* ``decode_permissive``: never fails; adds ``reject_reason`` (null when the
  message is valid) so one pass yields accepted rows and a reject side output.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adpulse.functions.constants import IMPRESSION_FIELDS


def encode_messages(impressions: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Impression rows -> ``value`` JSON string (plus passthrough columns ``keep``)."""
    value = F.to_json(F.struct(*[F.col(f) for f in IMPRESSION_FIELDS])).alias("value")
    return impressions.select(*keep, value)


VALUE_ALIAS = "_value"

# Spark type of each field and the JSON types, as a variant names them, that
# a message may give it in.
_NUMBER = "^(TINYINT|SMALLINT|INT|BIGINT|FLOAT|DOUBLE|DECIMAL.*)$"
FIELD_TYPES = {name: ("string", "^STRING$") for name in IMPRESSION_FIELDS}
FIELD_TYPES |= {"timestamp": ("bigint", "^(TINYINT|SMALLINT|INT|BIGINT)$"), "bid": ("double", _NUMBER)}


# A message as producers write it: the seven fields in order, strings without
# escapes, numbers that their types hold. Such a message is well formed.
_SHAPES = {"string": r'"[^"\\\x00-\x1f]*"', "bigint": r"-?(?:0|[1-9]\d{0,17})", "double": r"-?(?:0|[1-9]\d{0,15})(?:\.\d{1,17})?"}
USUAL = r"^\{" + ",".join(f'"{name}":{_SHAPES[FIELD_TYPES[name][0]]}' for name in IMPRESSION_FIELDS) + r"\}\z"


def _reason(m: Column, types: Column) -> Column:
    """What is wrong with a message, field by field; null if nothing is (it may
    have further fields). ``types``: of the message and of each field."""
    def absent(name):
        return types[name].isNull() | (types[name] == "VOID")

    def wrong(name):
        # a value that its own type cannot hold, or that is not finite, is wrong, too
        finite = F.abs(m["bid"]) < float("inf") if name == "bid" else m[name].isNotNull()
        return ~absent(name) & ~(types[name].rlike(FIELD_TYPES[name][1]) & F.coalesce(finite, F.lit(False)))

    def named(condition):
        return F.array_join(F.array_compact(F.array(*[F.when(condition(name), F.lit(name)) for name in IMPRESSION_FIELDS])), ",")

    lists = F.array(F.struct(named(wrong).alias("wrong"), named(absent).alias("absent")))
    return F.when(~F.coalesce(types["_message"].startswith("OBJECT"), F.lit(False)), F.lit("unparseable")).otherwise(
        F.transform(lists, lambda x: F.when(x["wrong"] != "", F.concat(F.lit("invalid:"), x["wrong"]))
                    .when(x["absent"] != "", F.concat(F.lit("missing:"), x["absent"])))[0])


def _parsed(messages: DataFrame, value_col: str, keep: tuple[str, ...]) -> DataFrame:
    """keep, _value, the seven fields and ``reject_reason``.

    A message of the usual shape is well formed and is parsed to its fields at
    once; any other is parsed to a variant and looked at field by field. Each
    parse passes a one-element ``explode``: a generated column is a barrier for
    the optimizer, so it is not repeated for each field that is read from it.
    """
    src = messages.withColumnRenamed(value_col, VALUE_ALIAS) if value_col != VALUE_ALIAS else messages
    text, schema = F.col(VALUE_ALIAS), ", ".join(f"{name} {kind}" for name, (kind, _) in FIELD_TYPES.items())
    once = src.select(*keep, VALUE_ALIAS, F.explode(F.transform(F.array(text.rlike(USUAL)), lambda usual: F.struct(
        F.when(usual, F.from_json(text, schema)).alias("fields"), F.when(~usual, F.try_parse_json(text)).alias("v")))).alias("_p"))
    v, usual = F.col("_p.v"), F.col("_p.fields")
    looked_up = F.struct(*[F.try_variant_get(v, f"$.{name}", kind).alias(name) for name, (kind, _) in FIELD_TYPES.items()])
    types = F.struct(F.schema_of_variant(v).alias("_message"), *[F.schema_of_variant(F.try_variant_get(v, f"$.{name}", "variant")).alias(name) for name in FIELD_TYPES])
    fields = once.select(*keep, VALUE_ALIAS, F.explode(F.array(F.struct(
        F.coalesce(usual, looked_up).alias("m"), F.when(usual.isNull(), types).alias("types")))).alias("_f"))
    m, types = F.col("_f.m"), F.col("_f.types")
    return fields.select(*keep, VALUE_ALIAS, m.alias("_m"), F.when(types.isNotNull(), _reason(m, types)).alias("reject_reason"))


def decode_strict(messages: DataFrame, value_col: str = "value",
                  keep: tuple[str, ...] = ()) -> DataFrame:
    """Decode every message or fail the query, naming the reason and the
    whole message.

    The check sits in the same projection as the fields, so it cannot be
    pruned away while any field is used downstream.
    """
    out = _parsed(messages, value_col, keep)
    checked = F.when(F.col("reject_reason").isNotNull(), F.raise_error(F.concat(
        F.lit("malformed impression, "), F.col("reject_reason"), F.lit(" in "),
        F.coalesce(F.col(VALUE_ALIAS), F.lit("null"))))).otherwise(F.col("_m"))
    return out.select(*keep, checked.alias("_c")).select(*keep, *[f"_c.{f}" for f in IMPRESSION_FIELDS])


def decode_permissive(messages: DataFrame, value_col: str = "value",
                      keep: tuple[str, ...] = ()) -> DataFrame:
    """Decode without failing: fields plus ``reject_reason``.

    reason: ``unparseable`` (not a JSON object), ``invalid:<fields>`` (of
    another JSON type, or a number that is not finite or too large),
    ``missing:<fields>`` (absent or null).
    """
    out = _parsed(messages, value_col, keep)
    return out.select(*keep, *[f"_m.{f}" for f in IMPRESSION_FIELDS], "reject_reason")


def accepted(decoded: DataFrame) -> DataFrame:
    return decoded.where(F.col("reject_reason").isNull()).drop("reject_reason")


def rejects(decoded: DataFrame) -> DataFrame:
    return decoded.where(F.col("reject_reason").isNotNull())
