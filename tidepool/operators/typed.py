"""P9 by the record's own schema: envelopes that carry the types of their fields.

Such a record is ``{"schema": {...}, "payload": {"before", "after", "op"}}``. Its schema
names the fields of both row images, which travel in the wire forms of their types:
decimals as base64 of their unscaled bytes, days and timestamps as numbers, rows within
rows as objects. Every field is decoded by what the record itself says of it, so tables of
any shape go through one expression; the outcome is that of ``cdc.normalize``, all values
as text.
"""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidepool.functions import json as J
from tidepool.operators.cdc import BAD_TOPIC, MALFORMED, NO_OP, OP_TYPES

_PLAIN = "field: string, type: string, name: string, parameters: map<string,string>"
_FIELDS = f"array<struct<{_PLAIN}, fields: array<struct<{_PLAIN}>>>>"
ENVELOPE = (f"struct<schema: struct<fields: array<struct<field: string, fields: {_FIELDS}>>>, "
            "payload: struct<before: map<string,string>, after: map<string,string>, op: string>, _corrupt_record: string>")

# Names that change sources give to the types of their fields (fixed values).
DECIMAL = "org.apache.kafka.connect.data.Decimal"
DAYS = ["io.debezium.time.Date", "org.apache.kafka.connect.data.Date"]
MILLIS = ["io.debezium.time.Timestamp", "org.apache.kafka.connect.data.Timestamp"]
MICROS = ["io.debezium.time.MicroTimestamp"]
ROW = "struct"

NO_SCHEMA = "no_schema"      # an envelope that does not say what its fields are
BAD_VALUE = "bad_value"      # a value that is none of its field's type


def _bound(value: Column, use) -> Column:
    """``use`` of a value that is computed once, however often ``use`` names it: the start and
    finish of a fold over nothing, which copies neither."""
    return F.aggregate(F.array(), value, lambda x, _: x, use)


def _whole_text(raw: Column) -> Column:
    """Hex digits of a big-endian two's complement number as decimal digits with their sign."""
    digit = "decimal(38,0)"

    def signed(digits):     # up to 64 bits at once
        return F.conv(F.lpad(digits, 16, F.when(raw >= "8", F.lit("F")).otherwise(F.lit("0"))), 16, -10)

    def add(acc, i):
        byte = F.conv(F.substring(raw, 2 * i - 1, F.lit(2)), 16, 10).cast(digit)
        return F.try_add(F.try_multiply(acc, F.lit(256).cast(digit)).cast(digit), byte).cast(digit)

    rest = F.sequence(F.lit(9), (F.length(raw) / 2).cast("int"))
    return (F.when(F.length(raw) > 16, F.aggregate(rest, signed(F.substring(raw, 1, 16)).cast(digit), add).cast("string"))
            .when(F.length(raw) > 0, signed(raw)))


def decimal_text(value: Column, scale: Column) -> Column:
    """Base64 of a big-endian two's complement number of up to 37 digits, with ``scale`` digits after the
    point; null if it is none or passes a decimal of 38 digits on the way."""
    def pointed(whole):
        # As text: a decimal's absolute value is rounded to 34 digits.
        digits = F.ltrim(whole, F.lit("-"))
        sign = F.when(whole.startswith("-"), F.lit("-")).otherwise(F.lit(""))
        return (F.when((scale > 0) & (F.length(digits) > scale), F.overlay(whole, F.lit("."), F.length(whole) - scale + 1, F.lit(0)))
                .when(scale > 0, F.concat(sign, F.lit("0."), F.lpad(digits, scale, F.lit("0")))).otherwise(whole))

    return _bound(_bound(F.hex(F.try_to_binary(value, F.lit("base64"))), _whole_text), pointed)


def value_text(value: Column, field: Column) -> Column:
    """A value as text, by its field's type; null if it is none of that type."""
    def by(name):
        def is_(*names):    # interpreted within lambdas, where a list costs more than equalities
            return reduce(or_, [name == n for n in names])

        return (F.when(name.isNull(), value)
                .when(is_(DECIMAL), _bound(F.coalesce(field["parameters"]["scale"].try_cast("int"), F.lit(0)), lambda s: decimal_text(value, s)))
                .when(is_(*DAYS), F.date_from_unix_date(value.try_cast("int")).cast("string"))
                .when(is_(*MILLIS), F.timestamp_millis(value.try_cast("long")).cast("string"))
                .when(is_(*MICROS), F.timestamp_micros(value.try_cast("long")).cast("string"))
                .otherwise(value))

    return _bound(field["name"], by)


def _by_name(fields: Column) -> Column:
    return F.map_from_arrays(fields["field"], fields)


def decoded(image: Column, fields: Column) -> Column:
    """A row image with every value as text by its field's type; rows within it as JSON text.
    Null fields stay null; values without a field stay as they are."""
    def row(value, field):
        inner = F.from_json(value, "map<string,string>")
        return F.to_json(_bound(_by_name(field["fields"]), lambda t: J.drop_null_values(
            F.transform_values(inner, lambda k, v: _bound(t[k], lambda f: value_text(v, f))))))

    def text(value, field):
        return F.when(field.isNull(), value).when(field["type"] == ROW, row(value, field)).otherwise(value_text(value, field))

    return F.when(image.isNotNull(), _bound(_by_name(fields), lambda t: F.transform_values(
        image, lambda k, v: F.when(v.isNotNull(), _bound(t[k], lambda f: text(v, f))))))


def normalize_typed(raw: DataFrame) -> DataFrame:
    """P9 for envelopes with their schema: ``(arrival, seq, topic, value)`` -> the columns of
    ``cdc.normalize``. A record that is malformed, does not carry its schema, holds a value
    that is none of its field's type, or has a topic that names no table gets a ``reason``
    and keeps what was received."""
    env = F.from_json(F.col("value"), ENVELOPE, {"columnNameOfCorruptRecord": "_corrupt_record"})
    parsed = J.evaluate_once(raw, env, "_env", ["arrival", "seq", "topic", "value"])

    def fields(part: str) -> Column:
        return F.filter(F.col("_env.schema.fields"), lambda f: f["field"] == part)[0]["fields"]

    payload, images = F.col("_env.payload"), ("before", "after")
    # Each step passes on only what later ones name: a record and its schema are far larger than its rows.
    ok = F.col("_env").isNotNull() & F.col("_env._corrupt_record").isNull() & J.opens_object(F.col("value"))
    read = parsed.select("arrival", "seq", "topic", "value", F.coalesce(ok, F.lit(False)).alias("_ok"), payload.isNotNull().alias("_payload"),
                         F.lower(payload["op"]).alias("_op"), *[J.last_wins(payload[part]).alias(f"_{part}") for part in images],
                         *[fields(part).alias(f"_{part}_fields") for part in images])
    described = F.coalesce(*[F.when(F.col(f"_{part}").isNotNull() & F.col(f"_{part}_fields").isNull(), F.lit(False)) for part in images], "_payload")
    texts = read.select("arrival", "seq", "topic", "value", "_ok", "_op", described.alias("_described"),
                        *[F.size(F.filter(F.map_values(f"_{part}"), lambda v: v.isNotNull())).alias(f"_{part}_values") for part in images],
                        *[J.drop_null_values(decoded(F.col(f"_{part}"), F.col(f"_{part}_fields"))).alias(part) for part in images])
    parts, op = F.split("topic", r"\."), F.col("_op")

    def lost(part: str) -> Column:
        """A value that was there and could not be decoded."""
        return F.coalesce(F.size(part) < F.col(f"_{part}_values"), F.lit(False))

    reason = (F.when(~F.col("_ok"), F.lit(MALFORMED)).when(F.size(parts) < 3, F.lit(BAD_TOPIC))
              .when(~F.col("_described"), F.lit(NO_SCHEMA)).when(op.isNull(), F.lit(NO_OP))
              .when(lost("before") | lost("after"), F.lit(BAD_VALUE)))
    type_ = F.coalesce(F.try_element_at(F.create_map(*[F.lit(x) for kv in OP_TYPES.items() for x in kv]), op), op)
    empty = F.create_map().cast("map<string,string>")
    return texts.select(
        "arrival", "seq", F.try_element_at(parts, F.lit(2)).alias("database"), F.try_element_at(parts, F.lit(3)).alias("table_name"),
        type_.alias("type"), *[F.coalesce(part, empty).alias(part) for part in images],
        reason.alias("reason"), F.when(reason.isNotNull(), F.struct("topic", "value")).alias("raw"))
