"""Message envelopes derived from the provided tables.

The engine consumes message-bus records ``(key, value, topic, partition,
offset, timestamp)``. No bus is available here, so the provided tables are
turned into such records with deterministic Spark expressions (one row in,
one or two messages out; map-only, no shuffle), and the real parser is run
on the JSON text. The same rules are restated column by column in the SQL
oracle, which never parses JSON, so the parser is tested independently.

Rules (``i`` = ``event_id``; see FIXTURES.md, part C):

* log records: common fields from ``user_id`` and ``i``; ``ts`` in epoch ms,
  sent quoted when ``i % 11 = 0``; ``err`` for error events; ``page`` for
  view/click/purchase; ``displays`` for views (``i % 4`` elements);
  ``actions`` for clicks (``1 + i % 3`` elements); ``start`` for signups
  (except ``i % 97 = 0``: neither branch) and for pages with ``i % 53 = 0``;
  malformed text when ``i % 211 = 0``; position ``(i % 4, i // 4)``.
* change records: one change per fact row (type chosen by ``key % 6``),
  two versions per dimension key (the second one wins unless its type is
  dropped; user keys with ``c_custkey % 7 = 0`` only get dropped types, so
  their lookups miss); position ``(key % 4, (key // 4) * 16 + slot)``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from daystream.functions.dates import epoch_ms_of

# The input topics of the log split and the change split.
LOG_TOPIC = "ODS_BASE_LOG"
CHANGE_TOPIC = "ODS_BASE_DB"

# Change types in the order chosen by ``key % 6``; the last
# two are not mapped to an operation and are dropped by the splitter.
CHANGE_TYPES = ["bootstrap-insert", "insert", "update", "delete", "bootstrap-start", "INSERT"]

# Position slot of each change source inside one key's offset block.
_SLOTS = {"order_info": 0, "order_detail": 2, "sku_info": 4,
          "user_info": (6, 7), "base_province": (8, 9)}

# Epoch ms of 2024-01-01T00:00:00Z; change timestamps count up from it.
_CHANGE_EPOCH_MS = 1704067200000


def _e(sql: str) -> Column:
    return F.expr(sql)


def _frag(name: str, json_text: Column) -> Column:
    return F.concat(F.lit(f'"{name}":'), json_text)


def log_envelopes(events: DataFrame) -> DataFrame:
    """App-log messages, one per ``events`` row."""
    ev = events.select(
        F.col("event_id").alias("i"), F.col("user_id").alias("u"), "event_type",
        epoch_ms_of("ts").alias("tsm"))

    common = _e("""named_struct(
        'ar', cast(u % 27 as string), 'ba', concat('ba_', i % 5),
        'ch', concat('ch_', i % 4), 'is_new', cast(i % 2 as string),
        'md', concat('md_', i % 7), 'mid', concat('mid_', u),
        'os', concat('os_', i % 3), 'uid', cast(u as string), 'vc', concat('v', i % 6))""")
    is_page = _e("event_type in ('view', 'click', 'purchase')")
    page = _e("""named_struct(
        'page_id', event_type, 'item', i % 50, 'item_type', 'sku_id',
        'last_page_id', case when i % 3 = 0 then null
                             when i % 3 = 1 and i % 5 = 0 then ''
                             else 'home' end,
        'source_type', case when i % 4 = 0 then 'promotion' else 'query' end,
        'during_time', i % 9000)""")
    displays = _e("""transform(filter(sequence(0, i % 4), p -> p > 0), p -> named_struct(
        'display_type', case when p % 2 = 1 then 'query' else 'promotion' end,
        'item', (i + p) % 100, 'item_type', 'sku_id', 'pos_id', p % 5 + 1, 'order', p))""")
    actions = _e("""transform(sequence(1, 1 + i % 3), p -> named_struct(
        'action_id', case p when 1 then 'favor_add' when 2 then 'cart_add' else 'get_coupon' end,
        'item', cast((i * 3 + p) % 100 as string), 'item_type', 'sku_id', 'ts', tsm + p))""")
    has_start = _e("""(event_type = 'signup' and i % 97 <> 0)
        or (event_type in ('view', 'click', 'purchase') and i % 53 = 0)""")
    start = _e("""named_struct(
        'entry', case when i % 2 = 0 then 'icon' else 'notice' end,
        'loading_time', i % 5000 + 100, 'open_ad_id', i % 20, 'open_ad_ms', i % 3000,
        'open_ad_skip_ms', case when i % 4 = 0 then null else i % 1000 end)""")
    err = _e("named_struct('error_code', 1000 + i % 7, 'msg', concat('err_', i % 13))")
    ts_text = _e("case when i % 11 = 0 then concat('\"', tsm, '\"') else cast(tsm as string) end")

    fragments = F.array(
        _frag("common", F.to_json(common)),
        F.when(is_page, _frag("page", F.to_json(page))),
        F.when(F.col("event_type") == "view", _frag("displays", F.to_json(displays))),
        F.when(F.col("event_type") == "click", _frag("actions", F.to_json(actions))),
        F.when(has_start, _frag("start", F.to_json(start))),
        F.when(F.col("event_type") == "error", _frag("err", F.to_json(err))),
        _frag("ts", ts_text),
    )
    good = F.concat(F.lit("{"), F.array_join(fragments, ","), F.lit("}"))
    malformed = _e("case i % 3 when 0 then '' when 1 then 'not json' else '[{\"a\":1}]' end")
    value = F.when(F.col("i") % 211 == 0, malformed).otherwise(good)

    return ev.select(
        F.lit(None).cast("string").alias("key"),
        value.alias("value"),
        F.lit(LOG_TOPIC).alias("topic"),
        (F.col("i") % 4).cast("int").alias("partition"),
        F.floor(F.col("i") / 4).cast("bigint").alias("offset"),
        F.timestamp_millis("tsm").alias("timestamp"),
    )


def _change_rows(df: DataFrame, table: str, key: Column, slot: int, type_sql: str,
                 data: Column) -> DataFrame:
    return df.select(
        key.cast("bigint").alias("k"), F.lit(slot).alias("slot"),
        F.lit(table).alias("tbl"), _e(type_sql).alias("typ"),
        F.to_json(data).alias("data_json"))


def _versions(df: DataFrame, table: str, key: Column, *versions) -> DataFrame:
    """Several changes ``(slot, type, data)`` of each row, from one scan."""
    each = F.array(*[F.struct(F.lit(slot).alias("slot"), _e(type_sql).alias("typ"),
                              F.to_json(data).alias("data_json"))
                     for slot, type_sql, data in versions])
    return (df.select(key.cast("bigint").alias("k"), F.lit(table).alias("tbl"), F.explode(each).alias("v"))
            .select("k", "v.slot", "tbl", "v.typ", "v.data_json"))


SOURCE_TABLES = ("order_info", "order_detail", "sku_info", "user_info", "base_province")


def change_envelopes(orders: DataFrame | None, lineitem: DataFrame | None,
                     part: DataFrame | None, customer: DataFrame | None,
                     nation: DataFrame | None, tables=SOURCE_TABLES) -> DataFrame:
    """Change-event messages for five source tables.

    ``order_info`` (orders) and ``order_detail`` (lineitem) are fact tables,
    ``user_info`` (customer) and ``base_province`` (nation) are dimensions,
    ``sku_info`` (part) is listed nowhere. ``tables`` limits the output to
    the changes of some source tables (the positions of the others are
    simply not produced), e.g. a job that only maintains dimensions.
    """
    types = ("element_at(array(" + ", ".join(f"'{t}'" for t in CHANGE_TYPES)
             + "), cast(k6 as int) + 1)")

    def by_key(sql_key):
        return types.replace("k6", f"({sql_key}) % 6")

    # Every customer gets its two user_info changes; for keys with
    # c_custkey % 7 = 0 both carry a type the splitter drops, so those users
    # have no dimension row and their lookups miss.
    def user_type(sql_type):
        return f"case when c_custkey % 7 = 0 then 'bootstrap-start' else {sql_type} end"
    u1, u2 = _SLOTS["user_info"]
    n1, n2 = _SLOTS["base_province"]
    builders = {
        "order_info": lambda: [_change_rows(
            orders, "order_info", F.col("o_orderkey"), _SLOTS["order_info"],
            by_key("o_orderkey"),
            _e("""named_struct('id', o_orderkey, 'user_id', o_custkey,
                 'order_status', o_orderstatus, 'total_amount', o_totalprice,
                 'create_time', date_format(o_orderdate, 'yyyy-MM-dd HH:mm:ss'))"""))],
        "order_detail": lambda: [_change_rows(
            lineitem, "order_detail", _e("l_orderkey * 8 + l_linenumber"),
            _SLOTS["order_detail"], by_key("l_orderkey * 8 + l_linenumber"),
            _e("""named_struct('id', l_orderkey * 8 + l_linenumber,
                 'order_id', l_orderkey, 'sku_id', l_partkey,
                 'sku_num', cast(l_quantity as bigint), 'order_price', l_extendedprice)"""))],
        "sku_info": lambda: [_change_rows(
            part, "sku_info", F.col("p_partkey"), _SLOTS["sku_info"], by_key("p_partkey"),
            _e("""named_struct('id', p_partkey, 'sku_name', p_name,
                 'tm_name', p_brand, 'price', p_retailprice)"""))],
        "user_info": lambda: [_versions(
            customer, "user_info", F.col("c_custkey"),
            (u1, user_type("'bootstrap-insert'"),
             _e("""named_struct('id', c_custkey, 'login_name', c_name,
                  'gender', 'U', 'birthday', '1990-01-01')""")),
            (u2, user_type(by_key("c_custkey")),
             _e("""named_struct('id', c_custkey, 'login_name', c_name,
                  'gender', case when c_custkey % 2 = 0 then 'M' else 'F' end,
                  'birthday', date_format(date_add(date'1950-01-01',
                      cast((c_custkey * 37) % 20000 as int)), 'yyyy-MM-dd'))""")))],
        "base_province": lambda: [_versions(
            nation, "base_province", F.col("n_nationkey"),
            (n1, "'bootstrap-insert'",
             _e("""named_struct('id', n_nationkey, 'name', concat(n_name, '_v1'),
                  'region_id', n_regionkey, 'area_code', '0',
                  'iso_code', concat('ISO_', n_nationkey),
                  'iso_3166_2', concat('CN-', n_nationkey))""")),
            (n2, by_key("n_nationkey"),
             _e("""named_struct('id', n_nationkey, 'name', n_name,
                  'region_id', n_regionkey,
                  'area_code', cast(110000 + n_nationkey * 10000 as string),
                  'iso_code', concat('ISO_', n_nationkey),
                  'iso_3166_2', concat('CN-', n_nationkey))""")))],
    }
    parts = [df for t in SOURCE_TABLES if t in tables for df in builders[t]()]
    rows = parts[0]
    for p in parts[1:]:
        rows = rows.unionByName(p)

    value = F.concat(F.lit('{"database":"shop","table":"'), F.col("tbl"),
                     F.lit('","type":"'), F.col("typ"), F.lit('","data":'),
                     F.col("data_json"), F.lit("}"))
    offset = (F.floor(F.col("k") / 4) * 16 + F.col("slot")).cast("bigint")
    return rows.select(
        F.lit(None).cast("string").alias("key"),
        value.alias("value"),
        F.lit(CHANGE_TOPIC).alias("topic"),
        (F.col("k") % 4).cast("int").alias("partition"),
        offset.alias("offset"),
        F.timestamp_millis(F.lit(_CHANGE_EPOCH_MS) + offset).alias("timestamp"),
    )


_SOURCE_OF = {"order_info": "orders", "order_detail": "lineitem", "sku_info": "part",
              "user_info": "customer", "base_province": "nation"}


def _source(spark: SparkSession, sf_dir: str, name: str,
            min_partitions: int | None = None) -> DataFrame:
    """One provided table; ``min_partitions`` spreads its rows round-robin (a
    file of one row group is one scan task), like the option of that name of
    the Kafka source. Its default is the session's ``daystream.minPartitions``."""
    from daystream.session import read_table
    df = read_table(spark, sf_dir, name)
    n = min_partitions or int(spark.conf.get("daystream.minPartitions", "0"))
    return df.repartition(n) if n else df


def change_envelopes_from(spark: SparkSession, sf_dir: str, tables=SOURCE_TABLES,
                          min_partitions: int | None = None) -> DataFrame:
    t = {_SOURCE_OF[n]: _source(spark, sf_dir, _SOURCE_OF[n], min_partitions) for n in tables}
    return change_envelopes(t.get("orders"), t.get("lineitem"), t.get("part"),
                            t.get("customer"), t.get("nation"), tables=tables)


def log_envelopes_from(spark: SparkSession, sf_dir: str,
                       min_partitions: int | None = None) -> DataFrame:
    return log_envelopes(_source(spark, sf_dir, "events", min_partitions))


# Which source tables are facts and which are dimensions
# (one table is deliberately in both lists).
ROUTING = [("order_info", "fact"), ("order_detail", "fact"), ("base_province", "fact"),
           ("user_info", "dim"), ("base_province", "dim")]


def routing_table(spark: SparkSession, rows=None) -> DataFrame:
    """Routing configuration ``(table, kind)`` as an inline relation (no
    job to build it); :func:`stored_routing` reads it from a table."""
    def q(x):
        return "'" + str(x).replace("'", "''") + "'"
    values = ", ".join(f"({q(t)}, {q(k)})" for t, k in (rows or ROUTING))
    return spark.sql(f"SELECT * FROM VALUES {values} AS routing(table, kind)")


def stored_routing(path: str, fmt: str = "parquet"):
    """A loader ``spark -> (table, kind)`` that reads the routing table at
    ``path`` each time it is called: the lists of a running query follow it."""
    def load(spark: SparkSession) -> DataFrame:
        return spark.read.schema("table string, kind string").format(fmt).load(path)
    return load
