"""Change-event split: op mapping, fact routing and latest dimension rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daystream import schemas
from daystream.functions.routing import DEAD_LETTER_TOPIC, TOPIC_SUFFIX, fact_topic, op_code
from daystream.functions.values import is_blank
from daystream.operators.parse import evaluate_once, parse_json


def parse_changes(env: DataFrame) -> DataFrame:
    """Change envelopes -> ``(src_topic, src_partition, src_offset, src_ts,
    type, table, data, dead_reason, value)``; ``data`` stays JSON text.

    ``dead_reason`` is ``empty``, ``corrupt``, ``missing_table``,
    ``missing_type`` or, for a change of a mapped type, ``missing_data``; else
    NULL. ``value`` is kept of dead messages only.
    """
    j = parse_json("value", schemas.CHANGE_JSON).alias("j")
    dead = (F.when(is_blank("value"), "empty")
            .when(F.col(f"j.{schemas.CORRUPT_COL}").isNotNull(), "corrupt")
            .when(F.col("j.table").isNull(), "missing_table")
            .when(F.col("j.type").isNull(), "missing_type")
            .when(op_code("j.type").isNotNull() & F.col("j.data").isNull(), "missing_data"))
    rows = evaluate_once(env.select(F.col("topic").alias("src_topic"),
                                    F.col("partition").alias("src_partition"),
                                    F.col("offset").alias("src_offset"),
                                    F.col("timestamp").alias("src_ts"), "value", j).select(
        "src_topic", "src_partition", "src_offset", "src_ts",
        F.col("j.type").alias("type"), F.col("j.table").alias("table"),
        F.col("j.data").alias("data"), dead.alias("dead_reason"), "value"))
    return rows.withColumn("value", F.when(F.col("dead_reason").isNotNull(), F.col("value")))


def change_dead_letter(changes: DataFrame, routing: DataFrame) -> DataFrame:
    """Messages the change split cannot use: ``(src_partition, src_offset,
    reason, value)``; besides the parser's reasons, ``missing_id`` for a change
    of a listed dimension table whose row image has no ``id``."""
    dims = routing.where(F.col("kind") == "dim").select("table", F.lit(True).alias("_dim")).distinct()
    # dead messages have no table to join on: a left join keeps them
    c = changes.join(dims, "table", "left")
    no_id = F.col("_dim") & op_code("type").isNotNull() & _id().isNull()
    reason = F.coalesce("dead_reason", F.when(no_id, F.lit("missing_id")))
    return c.where(reason.isNotNull()).select(
        "src_partition", "src_offset", reason.alias("reason"),
        F.coalesce("value", "data").alias("value"))


def with_op(changes: DataFrame) -> DataFrame:
    """Adds ``op`` (I/U/D); drops changes of any other type and dead messages."""
    return (changes.withColumn("op", op_code("type"))
            .where(F.col("op").isNotNull() & F.col("dead_reason").isNull()))


def _listed(changes: DataFrame, routing: DataFrame, kind: str) -> DataFrame:
    tables = routing.where(F.col("kind") == kind).select("table").distinct()
    return changes.join(tables, "table", "left_semi")


def fact_route(changes_op: DataFrame, routing: DataFrame,
               suffix: str = TOPIC_SUFFIX, key: str | None = None) -> DataFrame:
    """Changes of listed fact tables -> ``(topic, key, value, table, op,
    src_partition, src_offset)``; ``value`` is the row image ``data``.
    ``key`` names a field of the row image to send as the message key (none
    by default), so that a row's changes keep their order on the bus."""
    message_key = F.get_json_object("data", f"$.{key}") if key else F.lit(None).cast("string")
    facts = _listed(changes_op, routing, "fact")
    return facts.select(fact_topic("table", "op", suffix).alias("topic"),
                        message_key.alias("key"),
                        F.col("data").alias("value"), "table", "op",
                        "src_partition", "src_offset")


def route_messages(changes: DataFrame, routing: DataFrame, suffix: str = TOPIC_SUFFIX,
                   key: str | None = None) -> DataFrame:
    """Every outgoing message of parsed changes in one pass: ``(topic, key, value)``.

    The rows of :func:`fact_route` and of :func:`change_dead_letter`: a change
    meets the kinds of its table in one join (dead messages have no table, so
    a left one), and its messages are exploded; a table that is both a fact and a dimension
    may give two.
    """
    kinds = routing.where(F.col("kind").isin("fact", "dim")).groupBy("table").agg(
        F.bool_or(F.col("kind") == "fact").alias("_fact"), F.bool_or(F.col("kind") == "dim").alias("_dim"))
    c = changes.join(kinds, "table", "left").withColumn("op", op_code("type"))
    text = F.lit(None).cast("string")
    usable = F.col("op").isNotNull() & F.col("dead_reason").isNull()
    fact = F.when(F.col("_fact") & usable, F.struct(
        fact_topic("table", "op", suffix).alias("topic"),
        (F.get_json_object("data", f"$.{key}") if key else text).alias("key"), F.col("data").alias("value")))
    no_id = F.col("_dim") & F.col("op").isNotNull() & _id().isNull()
    dead = F.when(F.col("dead_reason").isNotNull() | no_id, F.struct(
        F.lit(DEAD_LETTER_TOPIC).alias("topic"), text.alias("key"),
        F.coalesce("value", "data", F.lit("")).alias("value")))
    return c.select(F.inline(F.array_compact(F.array(fact, dead))))


def dim_changes(changes_op: DataFrame, routing: DataFrame) -> DataFrame:
    """Changes of listed dimension tables with their key ``id``; one without
    an ``id`` is a dead letter (:func:`change_dead_letter`). Row images are read
    of the listed tables only: the condition on ``id`` would else move below
    the join and read those of all facts."""
    dims = evaluate_once(_listed(changes_op, routing, "dim"))
    return dims.withColumn("id", _id()).where(F.col("id").isNotNull())


def _id():
    return F.get_json_object("data", "$.id")


def dim_latest(dim_rows: DataFrame, stored: DataFrame | None = None,
               on_delete: str = "keep") -> DataFrame:
    """Latest row image per ``(table, id)``, last write wins.

    Order is message time, then partition, then offset (a bus keeps order
    only inside a partition; time orders changes of one key that landed in
    different partitions). A delete stores its row image like any other
    change (``on_delete="keep"``); ``on_delete="drop"`` removes the key.
    ``stored`` (same columns) is an earlier state that any new change
    overrides. Aggregation is partial (map-side), so a key that changes
    very often costs one row per task before the shuffle.

    Columns: ``table, id, data, op, src_partition, src_offset, src_ts``.
    """
    cols = ["table", "id", "data", "op", "src_partition", "src_offset", "src_ts"]
    rows = dim_rows.select(*cols).withColumn("_gen", F.lit(1))
    if stored is not None:
        rows = stored.select(*cols).withColumn("_gen", F.lit(0)).unionByName(rows)
    order = F.struct("_gen", "src_ts", "src_partition", "src_offset")
    payload = F.struct("data", "op", "src_partition", "src_offset", "src_ts")
    latest = (rows.groupBy("table", "id").agg(F.max_by(payload, order).alias("w"))
              .select("table", "id", "w.*"))
    if on_delete == "drop":
        latest = latest.where(F.col("op") != "D")
    elif on_delete != "keep":
        raise ValueError("on_delete must be 'keep' or 'drop'")
    return latest


def user_dim(latest: DataFrame) -> DataFrame:
    """``user_info`` rows -> ``(user_id, user_gender, birthday)``."""
    f = F.from_json("data", "gender string, birthday string").alias("f")
    return (latest.where(F.col("table") == "user_info")
            .select(F.col("id").alias("user_id"), f)
            .select("user_id", F.col("f.gender").alias("user_gender"),
                    F.col("f.birthday").alias("birthday")))


def province_dim(latest: DataFrame) -> DataFrame:
    """``base_province`` rows -> ``(province_id, province_name, ...)``."""
    f = F.from_json("data", "name string, iso_code string, iso_3166_2 string, "
                            "area_code string").alias("f")
    return (latest.where(F.col("table") == "base_province")
            .select(F.col("id").alias("province_id"), f)
            .select("province_id", F.col("f.name").alias("province_name"),
                    F.col("f.iso_code").alias("province_iso_code"),
                    F.col("f.iso_3166_2").alias("province_3166_2"),
                    F.col("f.area_code").alias("province_area_code")))


def route_counts(changes: DataFrame, routing: DataFrame,
                 suffix: str = TOPIC_SUFFIX) -> DataFrame:
    """Rows sent to each fact topic plus dimension writes per table
    (``DIM:<TABLE>``): ``(target, messages)``.

    One pass: each change meets its routing rows (0, 1 or 2: a table may be
    both a fact and a dimension) in a join, and the targets are
    counted with a partial aggregation.
    """
    kinds = routing.where(F.col("kind").isin("fact", "dim")).select("table", "kind").distinct()
    routed = with_op(changes).join(kinds, "table").where(
        (F.col("kind") == "fact") | _id().isNotNull())
    target = F.when(F.col("kind") == "fact", fact_topic("table", "op", suffix)).otherwise(
        F.concat(F.lit("DIM:"), F.upper("table")))
    return routed.groupBy(target.alias("target")).agg(F.count(F.lit(1)).alias("messages"))
