"""Change split: op mapping, routing, latest dimension rows."""

import json

from messages import envelopes

from daystream.operators import cdc
from daystream.sources.envelopes import routing_table


def change(t, table, data):
    return json.dumps({"type": t, "table": table, "data": data})


def parsed(spark, vals, start_offset=0):
    return cdc.parse_changes(envelopes(spark, vals, topic="ODS_BASE_DB",
                                       start_offset=start_offset))


def test_op_map_exact_and_case_sensitive(spark):
    types = ["bootstrap-insert", "insert", "update", "delete", "bootstrap-start", "INSERT",
             "Update", None]
    vals = [change(t, "order_info", {"id": n}) for n, t in enumerate(types)]
    got = [(r.type, r.op) for r in cdc.with_op(parsed(spark, vals)).orderBy("src_offset")
           .collect()]
    assert got == [("bootstrap-insert", "I"), ("insert", "I"), ("update", "U"),
                   ("delete", "D")]


def test_fact_routing_and_topic_names(spark):
    vals = [change("insert", "order_info", {"id": 1, "amount": 2.5}),
            change("update", "base_province", {"id": 3, "name": "x"}),
            change("insert", "sku_info", {"id": 4}),        # listed nowhere
            change("delete", "user_info", {"id": 5})]       # dimension only
    routed = cdc.fact_route(cdc.with_op(parsed(spark, vals)), routing_table(spark))
    got = sorted((r.topic, json.loads(r.value)["id"]) for r in routed.collect())
    assert got == [("DWD_BASE_PROVINCE_U_20220629", 3), ("DWD_ORDER_INFO_I_20220629", 1)]
    # routing is data: a changed list applies on the next batch
    routing2 = routing_table(spark, [("sku_info", "fact")])
    routed2 = cdc.fact_route(cdc.with_op(parsed(spark, vals)), routing2)
    assert [r.topic for r in routed2.collect()] == ["DWD_SKU_INFO_I_20220629"]


def test_dim_latest_last_write_wins_and_delete(spark):
    vals = [change("insert", "user_info", {"id": 1, "gender": "F"}),
            change("update", "user_info", {"id": 1, "gender": "M"}),
            change("insert", "user_info", {"id": 2, "gender": "F"}),
            change("delete", "user_info", {"id": 2, "gender": "F"}),
            change("bootstrap-start", "user_info", {"id": 1, "gender": "X"}),  # dropped
            change("insert", "base_province", {"id": 9, "name": "p"})]
    ops = cdc.with_op(parsed(spark, vals))
    rows = cdc.dim_changes(ops, routing_table(spark))
    keep = {(r.table, r.id): (json.loads(r.data), r.op)
            for r in cdc.dim_latest(rows).collect()}
    assert keep[("user_info", "1")] == ({"id": 1, "gender": "M"}, "U")
    assert keep[("user_info", "2")][1] == "D"  # a delete stores its row image
    assert ("base_province", "9") in keep
    dropped = {(r.table, r.id) for r in cdc.dim_latest(rows, on_delete="drop").collect()}
    assert ("user_info", "2") not in dropped and ("user_info", "1") in dropped


def test_dim_latest_merges_with_stored_state(spark):
    first = cdc.dim_latest(cdc.dim_changes(cdc.with_op(parsed(spark, [
        change("insert", "user_info", {"id": 1, "gender": "F"}),
        change("insert", "user_info", {"id": 2, "gender": "F"})])), routing_table(spark)))
    # a later batch whose offsets restart lower still overrides the stored rows
    second = cdc.dim_changes(cdc.with_op(parsed(spark, [
        change("update", "user_info", {"id": 1, "gender": "M"})])), routing_table(spark))
    merged = {r.id: json.loads(r.data)["gender"]
              for r in cdc.dim_latest(second, stored=first).collect()}
    assert merged == {"1": "M", "2": "F"}
    u = {r.user_id: r.user_gender for r in cdc.user_dim(cdc.dim_latest(second, first))
         .collect()}
    assert u == {"1": "M", "2": "F"}


def test_dimension_table_across_batches(spark):
    from daystream.plans import jobs
    from daystream.session import scratch_path
    out = scratch_path(spark, "dims-batches")

    def batch(vals, n, on_delete="keep"):
        env = envelopes(spark, vals, topic="ODS_BASE_DB", start_offset=100 - 10 * n)
        jobs.process_change_batch(spark, env, out, n, on_delete=on_delete)
        return {(r.table, r.id): json.loads(r.data)
                for r in jobs.read_dims(spark, f"{out}/dims").collect()}

    got = batch([change("insert", "user_info", {"id": k, "v": 0}) for k in range(50)]
                + [change("insert", "base_province", {"id": 1, "name": "a"})], 0)
    assert len(got) == 51
    # later batch wins even with lower offsets; untouched keys stay
    got = batch([change("update", "user_info", {"id": 3, "v": 1}),
                 change("delete", "user_info", {"id": 4, "v": 2})], 1)
    assert got[("user_info", "3")]["v"] == 1 and got[("user_info", "4")]["v"] == 2
    assert got[("user_info", "7")]["v"] == 0 and len(got) == 51
    got = batch([change("delete", "user_info", {"id": 5, "v": 9})], 2, on_delete="drop")
    assert ("user_info", "5") not in got and len(got) == 50
    only_users = jobs.read_dims(spark, f"{out}/dims", tables=("user_info",))
    assert only_users.where("table <> 'user_info'").count() == 0
    ledger = jobs.read_ledger(spark, f"{out}/ledger").collect()
    assert [(r.group_id, r.batch_id) for r in ledger] == [("ODS_BASE_DB_GROUP", 2)]


def test_ids_are_read_of_the_listed_tables_only(spark):
    """The condition on ``id`` stays above the join with the lists: no row image of a fact is parsed for it."""
    rows = [("insert", "user_info", '{"id":1}'), ("insert", "user_info", '{"x":1}'), ("insert", "order_info", '{"id":2}')]
    vals = [f'{{"table":"{t}","type":"{c}","data":{d}}}' for c, t, d in rows]
    parsed = cdc.with_op(cdc.parse_changes(envelopes(spark, vals, topic="ODS_BASE_DB")))
    dims = cdc.dim_changes(parsed, routing_table(spark))
    assert [(r.table, r.id) for r in dims.collect()] == [("user_info", "1")]
    plan = dims._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("get_json_object") < plan.index("Join LeftSemi") and "get_json_object" not in plan[plan.index("Join LeftSemi"):]


def test_value_is_kept_of_dead_messages_only(spark):
    vals = ["{", '{"table":"user_info","type":"insert","data":{"id":1}}', " "]
    got = cdc.parse_changes(envelopes(spark, vals, topic="ODS_BASE_DB")).collect()
    assert [(r.dead_reason, r.value) for r in got] == [("corrupt", "{"), (None, None), ("empty", " ")]
