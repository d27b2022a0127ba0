"""Log split: parsed app-log records -> page / display / action / start /
error streams.

Routing rules: a record with ``err`` goes whole to the error stream and
nowhere else; otherwise ``page`` and ``start`` are independent branches
(a record with both yields both, one with neither yields nothing);
displays and actions are only read inside the page branch, one output row
per non-null array element.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from daystream import schemas
from daystream.functions import routing
from daystream.functions.values import to_long
from daystream.operators.parse import usable

_POS = schemas.POSITION_COLS


def common_cols() -> list[Column]:
    """The nine common fields under their output names."""
    c = "common."
    return [F.col(c + "mid").alias("mid"), F.col(c + "uid").alias("user_id"),
            F.col(c + "ar").alias("province_id"), F.col(c + "ch").alias("channel"),
            F.col(c + "is_new").alias("is_new"), F.col(c + "md").alias("model"),
            F.col(c + "os").alias("operate_system"), F.col(c + "vc").alias("version_code"),
            F.col(c + "ba").alias("brand")]


def page_cols() -> list[Column]:
    p = "page."
    return [F.col(p + "page_id").alias("page_id"),
            F.col(p + "last_page_id").alias("last_page_id"),
            F.col(p + "item").alias("page_item"), F.col(p + "item_type").alias("page_item_type"),
            to_long(p + "during_time").alias("during_time"),
            F.col(p + "source_type").alias("sourceType")]


def _pages(parsed: DataFrame) -> DataFrame:
    return usable(parsed).where(F.col("page").isNotNull())


def page_log(parsed: DataFrame, with_position: bool = False) -> DataFrame:
    """Typed page records (16 columns)."""
    extra = _POS if with_position else []
    return _pages(parsed).select(*common_cols(), *page_cols(), "ts", *extra)


def display_log(parsed: DataFrame, with_position: bool = False) -> DataFrame:
    """One row per display element of a page record (21 columns)."""
    extra = _POS if with_position else []
    d = (_pages(parsed)
         .select(*common_cols(), *page_cols(), "ts", *extra, F.explode("displays").alias("d"))
         .where(F.col("d").isNotNull()))
    return d.select(*[F.col(n) for n in schemas.PAGE_LOG.names if n != "ts"],
                    F.col("d.display_type").alias("display_type"),
                    F.col("d.item").alias("display_item"),
                    F.col("d.item_type").alias("display_item_type"),
                    F.col("d.order").alias("display_order"),
                    F.col("d.pos_id").alias("display_pos_id"), "ts", *extra)


def action_log(parsed: DataFrame, with_position: bool = False) -> DataFrame:
    """One row per action element of a page record (20 columns)."""
    extra = _POS if with_position else []
    a = (_pages(parsed)
         .select(*common_cols(), *page_cols(), "ts", *extra, F.explode("actions").alias("a"))
         .where(F.col("a").isNotNull()))
    return a.select(*[F.col(n) for n in schemas.PAGE_LOG.names if n != "ts"],
                    F.col("a.action_id").alias("action_id"),
                    F.col("a.item").alias("action_item"),
                    F.col("a.item_type").alias("action_item_type"),
                    to_long("a.ts").alias("action_ts"), "ts", *extra)


def start_cols() -> list[Column]:
    s = "start."
    return [F.col(s + "entry").alias("entry"), F.col(s + "open_ad_id").alias("open_ad_id"),
            to_long(s + "loading_time").alias("loading_time_ms"),
            to_long(s + "open_ad_ms").alias("open_ad_ms"),
            to_long(s + "open_ad_skip_ms").alias("open_ad_skip_ms")]


def start_log(parsed: DataFrame, with_position: bool = False) -> DataFrame:
    """Typed start records (15 columns)."""
    extra = _POS if with_position else []
    return (usable(parsed).where(F.col("start").isNotNull())
            .select(*common_cols(), *start_cols(), "ts", *extra))


def error_log(parsed: DataFrame) -> DataFrame:
    """Error records, forwarded unchanged: ``(src_partition, src_offset, value)``."""
    return parsed.where(F.col("dead_reason").isNull() & F.col("err").isNotNull()).select(
        "src_partition", "src_offset", "value")


def _msg(topic: str, value: Column) -> Column:
    return F.struct(F.lit(topic).alias("topic"), value.alias("value"))


def route_messages(parsed: DataFrame, include_dead_letter: bool = True) -> DataFrame:
    """Every output message of the log split in ONE pass over the input.

    Each record builds the array of its outgoing messages (error, page,
    displays, actions, start, dead letter) and the array is exploded:
    map-only, no shuffle, the source is read once whatever the number of
    target topics. Values are JSON with NULL fields left out; error and
    dead-letter records are forwarded as received.

    Columns: ``topic, key, value, src_partition, src_offset``.
    """
    ok = F.col("dead_reason").isNull() & F.col("err").isNull()
    page_ok = ok & F.col("page").isNotNull()
    base = common_cols() + page_cols()

    page_json = F.to_json(F.struct(*base, F.col("ts")))
    disp_json = F.transform(
        F.filter(F.coalesce(F.col("displays"), F.array()), lambda d: d.isNotNull()),
        lambda d: _msg(routing.DISPLAY_TOPIC, F.to_json(F.struct(
            *base, d["display_type"].alias("display_type"), d["item"].alias("display_item"),
            d["item_type"].alias("display_item_type"), d["order"].alias("display_order"),
            d["pos_id"].alias("display_pos_id"), F.col("ts")))))
    act_json = F.transform(
        F.filter(F.coalesce(F.col("actions"), F.array()), lambda a: a.isNotNull()),
        lambda a: _msg(routing.ACTION_TOPIC, F.to_json(F.struct(
            *base, a["action_id"].alias("action_id"), a["item"].alias("action_item"),
            a["item_type"].alias("action_item_type"),
            a["ts"].try_cast("bigint").alias("action_ts"), F.col("ts")))))
    start_json = F.to_json(F.struct(*common_cols(), *start_cols(), F.col("ts")))

    empty = F.array().cast("array<struct<topic:string,value:string>>")

    def one(cond: Column, topic: str, value: Column) -> Column:
        return F.when(cond, F.array(_msg(topic, value))).otherwise(empty)

    msgs = F.concat(
        one(F.col("dead_reason").isNull() & F.col("err").isNotNull(), routing.ERROR_TOPIC,
            F.col("value")),
        one(page_ok, routing.PAGE_TOPIC, page_json),
        F.when(page_ok, disp_json).otherwise(empty),
        F.when(page_ok, act_json).otherwise(empty),
        one(ok & F.col("start").isNotNull(), routing.START_TOPIC, start_json),
        one(F.col("dead_reason").isNotNull() if include_dead_letter else F.lit(False),
            routing.DEAD_LETTER_TOPIC, F.coalesce(F.col("value"), F.lit(""))),
    )
    return (parsed.select("src_partition", "src_offset", F.explode(msgs).alias("m"))
            .select(F.col("m.topic").alias("topic"), F.lit(None).cast("string").alias("key"),
                    F.col("m.value").alias("value"), "src_partition", "src_offset"))


def topic_counts(messages: DataFrame) -> DataFrame:
    """Messages per target topic: ``(topic, messages)``."""
    return messages.groupBy("topic").agg(F.count(F.lit(1)).alias("messages"))


def route_counts(parsed: DataFrame) -> DataFrame:
    """One row of record-level branch counts of the log split."""
    ok = F.col("dead_reason").isNull() & F.col("err").isNull()
    page = ok & F.col("page").isNotNull()
    start = ok & F.col("start").isNotNull()
    nd = F.size(F.filter(F.coalesce("displays", F.array()), lambda d: d.isNotNull()))
    na = F.size(F.filter(F.coalesce("actions", F.array()), lambda d: d.isNotNull()))
    return parsed.agg(
        F.count(F.lit(1)).alias("n_records"),
        F.count_if(F.col("dead_reason").isNotNull()).alias("n_dead"),
        F.count_if(F.col("dead_reason").isNull() & F.col("err").isNotNull()).alias("n_error"),
        F.count_if(page).alias("n_page"),
        F.count_if(start).alias("n_start"),
        F.count_if(page & start).alias("n_page_and_start"),
        F.count_if(ok & ~page & ~start).alias("n_neither"),
        F.sum(F.when(page, nd).otherwise(0)).cast("bigint").alias("n_display_rows"),
        F.sum(F.when(page, na).otherwise(0)).cast("bigint").alias("n_action_rows"),
    )
