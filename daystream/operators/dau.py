"""Daily active users: session-first pages -> first page per (day, device)
-> user and province dimensions -> one record per (dt, mid)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daystream import schemas
from daystream.functions.dates import age_years, dt_of, hr_of


def session_first_pages(pages: DataFrame) -> DataFrame:
    """Pages that open a session: ``last_page_id IS NULL``.

    Only a real NULL counts; an empty string is a (blank) previous page.
    """
    return pages.where(F.col("last_page_id").isNull())


def with_dt(pages: DataFrame, tz: str | None = None) -> DataFrame:
    """Adds the calendar day ``dt`` ('yyyy-MM-dd' of ``ts`` in ``tz``)."""
    return pages.withColumn("dt", dt_of("ts", tz))


def first_seen(pages: DataFrame, tz: str | None = None) -> DataFrame:
    """Exactly one page per ``(dt, mid)``: the earliest by ``(ts,
    src_partition, src_offset)``, i.e. the first to arrive.

    A grouped ``min_by`` rather than a window: the aggregate is partial, so
    each task reduces its rows to one per key before the shuffle; a device
    that produces a third of all pages costs one row per task, not a hot
    partition. Input needs ``ts``, ``mid`` and the position columns; all
    columns are kept and ``dt`` is added.
    """
    df = pages if "dt" in pages.columns else with_dt(pages, tz)
    keep = [c for c in df.columns if c not in ("dt", "mid")]
    order = F.struct("ts", *schemas.POSITION_COLS)
    return (df.groupBy("dt", "mid")
            .agg(F.min_by(F.struct(*keep), order).alias("r"))
            .select("mid", "r.*", "dt"))


def join_user(df: DataFrame, users: DataFrame, as_of=None,
              tz: str | None = None) -> DataFrame:
    """Left join on ``user_id`` adding ``user_gender`` and ``user_age``.

    A missing user keeps the row with NULLs. The user dimension grows with
    the customer base, so no broadcast hint: AQE picks broadcast or
    sort-merge from the runtime size.
    """
    u = users.select("user_id", "user_gender",
                     age_years("birthday", as_of, tz).alias("user_age"))
    return df.join(u, "user_id", "left")


def join_province(df: DataFrame, provinces: DataFrame) -> DataFrame:
    """Left join on ``province_id`` adding name and codes.

    The province dimension is tens of rows, but it is the output of an
    aggregation, so its size is measured rather than assumed: AQE materialises
    it and turns the join into a broadcast join when the measured size is under
    ``spark.sql.adaptive.autoBroadcastJoinThreshold`` (sort-merge otherwise).
    """
    return df.join(provinces, "province_id", "left")


def dau_info(first: DataFrame, users: DataFrame, provinces: DataFrame,
             as_of=None, tz: str | None = None) -> DataFrame:
    """The DAU record (23 columns, ``dt``/``hr`` from ``ts`` in ``tz``)."""
    j = join_province(join_user(first, users, as_of, tz), provinces)
    j = j.withColumn("hr", hr_of("ts", tz))
    return j.select(*schemas.DAU_INFO.names)


def seen_mids(dau_table: DataFrame) -> DataFrame:
    """Devices already counted: distinct ``(dt, mid)`` of the stored result."""
    return dau_table.select("dt", "mid").distinct()


def new_only(candidates: DataFrame, seen: DataFrame) -> DataFrame:
    """Drops candidates whose ``(dt, mid)`` is already counted.

    The stored side is first reduced to the keys among the candidates, a semi
    join whose small side is the batch: a micro-batch is broadcast and the
    stored days stay where they are instead of being shuffled; only a batch as
    large as a back-fill shuffles both. The anti join then meets at most one
    row per candidate. ``candidates`` is read twice, so it should be staged.
    """
    seen = seen.select("dt", "mid").join(candidates.select("dt", "mid"), ["dt", "mid"], "left_semi")
    return candidates.join(seen, ["dt", "mid"], "left_anti")


def funnel_counts(pages: DataFrame, users: DataFrame | None = None,
                  provinces: DataFrame | None = None, tz: str | None = None) -> DataFrame:
    """Row counts along the DAU funnel as ``(stage, rows)``: all pages,
    session-first pages, first-seen devices, and how many of those found a
    user / a province.

    One pass over the pages: a grouped aggregation per ``(dt, mid)``
    counts pages and session-first pages and keeps the first-seen page's
    keys (``min_by`` skips rows whose ordering is NULL, i.e. pages that do
    not open a session); the dimension matches are then counted on that
    result. Long format: one row per stage.
    """
    first_order = F.when(F.col("last_page_id").isNull(),
                         F.struct("ts", *schemas.POSITION_COLS))
    per_key = (with_dt(pages, tz).groupBy("dt", "mid").agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(F.col("last_page_id").isNull()).alias("n_sf"),
        F.min_by(F.struct("user_id", "province_id"), first_order).alias("f"))
        .select("n", "n_sf", "f.user_id", "f.province_id"))
    if users is not None:
        per_key = per_key.join(users.select("user_id", F.lit(1).alias("_u")), "user_id", "left")
    else:
        per_key = per_key.withColumn("_u", F.lit(None).cast("int"))
    if provinces is not None:
        per_key = per_key.join(provinces.select("province_id", F.lit(1).alias("_p")),
                               "province_id", "left")
    else:
        per_key = per_key.withColumn("_p", F.lit(None).cast("int"))
    totals = per_key.agg(
        F.sum("n").alias("pages"), F.sum("n_sf").alias("session_first"),
        F.count_if(F.col("n_sf") > 0).alias("first_seen"),
        F.count("_u").alias("user_matched"), F.count("_p").alias("province_matched"))
    names = ["pages", "session_first", "first_seen", "user_matched", "province_matched"]
    return totals.select(F.explode(F.array(*[
        F.struct(F.lit(n).alias("stage"), F.coalesce(F.col(n), F.lit(0)).cast("bigint")
                 .alias("rows")) for n in names])).alias("s")).select("s.*")


def rows_per_task(df: DataFrame, **counts) -> DataFrame:
    """Counts held by each task of ``df`` as ``(stage, task, rows)``, one stage per
    named count (one row per task and stage after the partial aggregation)."""
    per = df.groupBy(F.spark_partition_id().alias("task")).agg(*[c.alias(n) for n, c in counts.items()])
    return per.select(F.explode(F.array(*[
        F.struct(F.lit(n).alias("stage"), "task", F.col(n).cast("bigint").alias("rows"))
        for n in counts])).alias("s")).select("s.*")


def batch_funnel(pages: DataFrame, new: DataFrame, users: DataFrame, provinces: DataFrame) -> DataFrame:
    """The funnel of one batch as ``(stage, task, rows)``: its pages, session-first
    pages, devices counted first by this batch (``new``, staged), and how many of
    those found a user / a province. Summed over all batches of a topic it is
    :func:`funnel_counts`."""
    every = F.count(F.lit(1))
    out = rows_per_task(pages, pages=every, session_first=F.count_if(F.col("last_page_id").isNull()))
    parts = [rows_per_task(new, first_seen=every),
             rows_per_task(new.join(users.select("user_id"), "user_id"), user_matched=every),
             rows_per_task(new.join(provinces.select("province_id"), "province_id"), province_matched=every)]
    for p in parts:
        out = out.unionByName(p)
    return out
