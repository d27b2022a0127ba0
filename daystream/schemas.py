"""Record schemas.

Input envelopes are parsed with STRING leaves only: a typed BIGINT leaf in
``from_json`` turns a quoted number into NULL and marks the whole record
corrupt, while a STRING leaf accepts numbers, booleans and nested objects
as text. Long fields are then converted with ``try_cast``.

Output records use the field names and order of the typed log records
(String and Long only).
"""

from __future__ import annotations

from pyspark.sql import types as T

S = T.StringType()
L = T.LongType()


def _struct(fields, typ=S):
    return T.StructType([T.StructField(f, typ) for f in fields])


# ---------------------------------------------------------------- inputs

#: Message as a message bus delivers it (column layout of Spark's Kafka source).
ENVELOPE = T.StructType([
    T.StructField("key", S),
    T.StructField("value", S),
    T.StructField("topic", S),
    T.StructField("partition", T.IntegerType()),
    T.StructField("offset", L),
    T.StructField("timestamp", T.TimestampType()),
])

CORRUPT_COL = "_corrupt"

#: App-log object: common fields, page, displays[], actions[], start, err, ts.
LOG_JSON = T.StructType([
    T.StructField("common", _struct(["ar", "ba", "ch", "is_new", "md", "mid", "os", "uid", "vc"])),
    T.StructField("page", _struct(["page_id", "item", "item_type", "last_page_id",
                                   "source_type", "during_time"])),
    T.StructField("displays", T.ArrayType(_struct(["display_type", "item", "item_type",
                                                   "pos_id", "order"]))),
    T.StructField("actions", T.ArrayType(_struct(["action_id", "item", "item_type", "ts"]))),
    T.StructField("start", _struct(["entry", "loading_time", "open_ad_id", "open_ad_ms",
                                    "open_ad_skip_ms"])),
    T.StructField("err", S),
    T.StructField("ts", S),
    T.StructField(CORRUPT_COL, S),
])

#: Change-event object; ``data`` is kept as JSON text.
CHANGE_JSON = T.StructType([
    T.StructField("type", S),
    T.StructField("table", S),
    T.StructField("data", S),
    T.StructField(CORRUPT_COL, S),
])

# --------------------------------------------------------------- outputs

COMMON_FIELDS = ["mid", "user_id", "province_id", "channel", "is_new", "model",
                 "operate_system", "version_code", "brand"]
PAGE_FIELDS = ["page_id", "last_page_id", "page_item", "page_item_type",
               "during_time", "sourceType"]


def _typed(names, longs):
    return T.StructType([T.StructField(n, L if n in longs else S) for n in names])


PAGE_LOG = _typed(COMMON_FIELDS + PAGE_FIELDS + ["ts"], {"during_time", "ts"})

DISPLAY_LOG = _typed(
    COMMON_FIELDS + PAGE_FIELDS + ["display_type", "display_item", "display_item_type",
                                   "display_order", "display_pos_id", "ts"],
    {"during_time", "ts"})

ACTION_LOG = _typed(
    COMMON_FIELDS + PAGE_FIELDS + ["action_id", "action_item", "action_item_type",
                                   "action_ts", "ts"],
    {"during_time", "action_ts", "ts"})

START_LOG = _typed(
    COMMON_FIELDS + ["entry", "open_ad_id", "loading_time_ms", "open_ad_ms",
                     "open_ad_skip_ms", "ts"],
    {"loading_time_ms", "open_ad_ms", "open_ad_skip_ms", "ts"})

DAU_INFO = _typed(
    COMMON_FIELDS + ["page_id", "page_item", "page_item_type", "sourceType", "during_time",
                     "user_gender", "user_age", "province_name", "province_iso_code",
                     "province_3166_2", "province_area_code", "dt", "hr", "ts"],
    {"during_time", "ts"})

#: Columns carried next to a typed record to keep its source position.
POSITION_COLS = ["src_partition", "src_offset"]

LEDGER = T.StructType([
    T.StructField("group_id", S),
    T.StructField("topic", S),
    T.StructField("partition", T.IntegerType()),
    T.StructField("until_offset", L),
    T.StructField("batch_id", L),
    T.StructField("saved_at", T.TimestampType()),
    T.StructField("run", L),
])
