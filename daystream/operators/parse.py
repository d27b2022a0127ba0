"""Envelope parsing (schema-on-read) and the dead-letter rule."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from daystream import schemas
from daystream.functions.values import is_blank, to_long

_PARSE_OPTS = {"columnNameOfCorruptRecord": schemas.CORRUPT_COL, "mode": "PERMISSIVE"}


def evaluate_once(df: DataFrame) -> DataFrame:
    """Evaluate ``df``'s columns once per row before any later filter.

    Catalyst pushes a filter below a projection by substituting the
    projected expressions into the condition; for an expensive projection
    (``from_json`` over the message text) that parses every message again
    inside the filter, once per referenced field, and a condition that
    large falls out of code generation. A one-element ``inline`` is a
    generator, which filters on its output cannot be pushed through: the
    parse happens once, the filter runs on its result.
    """
    return df.select(F.inline(F.array(F.struct(*[F.col(c) for c in df.columns]))))


def parse_json(value, schema) -> Column:
    """JSON text -> struct; malformed text fills ``_corrupt`` instead of
    failing the job."""
    return F.from_json(F.col(value) if isinstance(value, str) else value, schema, _PARSE_OPTS)


def parse_log(env: DataFrame) -> DataFrame:
    """App-log envelopes -> one row per message with the parsed object.

    Columns: ``src_partition, src_offset, value, common, page, displays,
    actions, start, err, ts, dead_reason``; ``ts`` is the record time in
    epoch ms (NULL if missing or not a whole number). ``dead_reason`` is
    NULL for usable records, else one of ``empty`` (NULL/blank text),
    ``corrupt`` (not a JSON object or wrongly typed nesting),
    ``missing_common``, ``missing_mid``, ``missing_ts``,
    ``missing_during_time``, ``missing_loading_time`` or ``missing_action_ts``
    (the other longs a record must have). Error records are checked for text only: they
    are forwarded whole.
    """
    j = parse_json("value", schemas.LOG_JSON).alias("j")
    p = env.select(F.col("partition").alias("src_partition"),
                   F.col("offset").alias("src_offset"), "value", j)
    p = p.select("src_partition", "src_offset", "value", "j.*")
    ts = to_long("ts")
    dead = (F.when(is_blank("value"), "empty")
            .when(F.col(schemas.CORRUPT_COL).isNotNull(), "corrupt")
            .when(F.col("err").isNotNull(), F.lit(None))
            .when(F.col("common").isNull(), "missing_common")
            .when(F.col("common.mid").isNull(), "missing_mid")
            .when(ts.isNull(), "missing_ts")
            .when(F.col("page").isNotNull() & to_long("page.during_time").isNull(),
                  "missing_during_time")
            .when(F.col("start").isNotNull() & to_long("start.loading_time").isNull(),
                  "missing_loading_time")
            .when(F.col("page").isNotNull() & F.exists(
                F.coalesce("actions", F.array()),
                lambda a: a.isNotNull() & a["ts"].try_cast("bigint").isNull()),
                "missing_action_ts"))
    return evaluate_once(p.select(
        "src_partition", "src_offset", "value", "common", "page", "displays", "actions",
        "start", "err", ts.alias("ts"), dead.alias("dead_reason")))


def usable(parsed: DataFrame) -> DataFrame:
    """Records that are neither dead letters nor error records."""
    return parsed.where(F.col("dead_reason").isNull() & F.col("err").isNull())


def dead_letter(parsed: DataFrame) -> DataFrame:
    """Records the splitter cannot use: ``(src_partition, src_offset, reason, value)``."""
    return parsed.where(F.col("dead_reason").isNotNull()).select(
        "src_partition", "src_offset", F.col("dead_reason").alias("reason"), "value")


def envelope_summary(parsed: DataFrame) -> DataFrame:
    """One typed row per message: what the parser found in it."""
    return parsed.select(
        "src_partition", "src_offset", "ts",
        F.col("dead_reason").isNotNull().alias("is_dead"),
        (F.col("dead_reason").isNull() & F.col("err").isNotNull()).alias("has_err"),
        F.col("page").isNotNull().alias("has_page"),
        F.col("start").isNotNull().alias("has_start"),
        F.coalesce(F.size("displays"), F.lit(-1)).alias("n_displays"),
        F.coalesce(F.size("actions"), F.lit(-1)).alias("n_actions"),
        F.col("common.mid").alias("mid"),
    )


def parse_page_messages(env: DataFrame) -> DataFrame:
    """Page-topic messages (page records as JSON) -> typed page records.

    The page topic carries JSON written by this engine, so the typed schema
    is applied through STRING leaves and ``try_cast`` as for raw logs. The
    message position is kept as ``src_partition, src_offset``. Messages that
    are no usable page record are left to :func:`page_dead_letter`.
    """
    return read_page_messages(env).where(F.col("dead_reason").isNull()).drop("dead_reason", "value")


def page_dead_letter(env: DataFrame) -> DataFrame:
    """Page-topic messages without a usable record: ``(src_partition,
    src_offset, reason, value)``."""
    return dead_letter(read_page_messages(env))


def read_page_messages(env: DataFrame) -> DataFrame:
    """Every page-topic message with ``dead_reason``: ``empty``, ``corrupt``,
    ``missing_mid``, ``missing_ts`` or NULL; ``value`` is kept of dead ones."""
    leaves = F.from_json("value", _all_string(schemas.PAGE_LOG), _PARSE_OPTS).alias("j")
    p = env.select(F.col("partition").alias("src_partition"),
                   F.col("offset").alias("src_offset"), "value", leaves)
    dead = (F.when(is_blank("value"), "empty")
            .when(F.col(f"j.{schemas.CORRUPT_COL}").isNotNull(), "corrupt")
            .when(F.col("j.mid").isNull(), "missing_mid")
            .when(to_long("j.ts").isNull(), "missing_ts"))
    cols = [to_long(f"j.{f.name}").alias(f.name) if f.dataType == schemas.L
            else F.col(f"j.{f.name}").alias(f.name) for f in schemas.PAGE_LOG.fields]
    return evaluate_once(p.select(*cols, "src_partition", "src_offset",
                                  dead.alias("dead_reason"),
                                  F.when(dead.isNotNull(), F.col("value")).alias("value")))


def _all_string(schema):
    from pyspark.sql import types as T
    return T.StructType([T.StructField(f.name, T.StringType()) for f in schema.fields]
                        + [T.StructField(schemas.CORRUPT_COL, T.StringType())])
