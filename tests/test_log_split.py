"""Routing rules of the log split on hand-made records."""

import json

from messages import envelopes

from daystream.functions import routing as R
from daystream.operators import log_split
from daystream.operators.parse import parse_log

COMMON = {"ar": "11", "ba": "acme", "ch": "web", "is_new": "1", "md": "A9",
          "mid": "dev-7", "os": "os 3", "uid": "u7", "vc": "0.9"}
PAGE = {"during_time": 777, "item": "41", "item_type": "sku_id",
        "last_page_id": "search", "page_id": "detail", "source_type": "query"}
START = {"entry": "icon", "loading_time": 100, "open_ad_id": 3, "open_ad_ms": 50}


def rec(**kw):
    r = {"common": COMMON, "ts": 1000}
    r.update(kw)
    return json.dumps(r)


def parsed(spark, vals):
    return parse_log(envelopes(spark, vals))


def test_page_and_start_independent(spark):
    p = parsed(spark, [rec(page=PAGE, start=START), rec(), rec(start=START)])
    assert log_split.page_log(p).count() == 1
    starts = log_split.start_log(p).collect()
    assert len(starts) == 2
    assert starts[0].open_ad_skip_ms is None  # optional long stays NULL
    assert starts[0].loading_time_ms == 100 and starts[0].open_ad_id == "3"
    counts = log_split.route_counts(p).collect()[0]
    assert (counts.n_page, counts.n_start, counts.n_page_and_start, counts.n_neither) == \
        (1, 2, 1, 1)


def test_error_record_goes_only_to_error(spark):
    v = rec(page=PAGE, start=START, err={"error_code": 1, "msg": "x"})
    p = parsed(spark, [v])
    assert log_split.page_log(p).count() == 0
    assert log_split.start_log(p).count() == 0
    errs = log_split.error_log(p).collect()
    assert [e.value for e in errs] == [v]


def test_page_fields_and_names(spark):
    row = log_split.page_log(parsed(spark, [rec(page=PAGE)])).collect()[0].asDict()
    assert row == {"mid": "dev-7", "user_id": "u7", "province_id": "11", "channel": "web",
                   "is_new": "1", "model": "A9", "operate_system": "os 3",
                   "version_code": "0.9", "brand": "acme", "page_id": "detail",
                   "last_page_id": "search", "page_item": "41",
                   "page_item_type": "sku_id", "during_time": 777,
                   "sourceType": "query", "ts": 1000}


def test_displays_and_actions(spark):
    disp = [{"display_type": "query", "item": 3, "item_type": "sku_id", "pos_id": 1,
             "order": 1}, None, {"display_type": "promotion", "item": "4", "order": "2"}]
    acts = [{"action_id": "cart_add", "item": "3", "item_type": "sku_id", "ts": "1005"}]
    p = parsed(spark, [rec(page=PAGE, displays=disp, actions=acts),
                       rec(page=PAGE, displays=[], actions={"not": "an array"}),
                       rec(displays=disp)])  # displays outside a page are ignored
    d = log_split.display_log(p).orderBy("display_order").collect()
    assert [(r.display_item, r.display_order, r.display_pos_id) for r in d] == \
        [("3", "1", "1"), ("4", "2", None)]
    assert len(log_split.display_log(p).columns) == 21
    a = log_split.action_log(p).collect()
    assert [(r.action_id, r.action_ts, r.ts) for r in a] == [("cart_add", 1005, 1000)]
    assert len(log_split.action_log(p).columns) == 20


def test_route_messages_one_pass(spark):
    disp = [{"display_type": "query", "item": 3, "order": 1}]
    vals = [rec(page=PAGE, displays=disp, start=START), rec(err={"a": 1}), "oops",
            rec(page=dict(PAGE, last_page_id=None))]
    msgs = log_split.route_messages(parsed(spark, vals))
    got = {r.topic: r.messages for r in log_split.topic_counts(msgs).collect()}
    assert got == {R.PAGE_TOPIC: 2, R.DISPLAY_TOPIC: 1, R.START_TOPIC: 1, R.ERROR_TOPIC: 1,
                   R.DEAD_LETTER_TOPIC: 1}
    page_vals = [json.loads(r.value) for r in msgs.where(f"topic = '{R.PAGE_TOPIC}'").collect()]
    # NULL fields are left out of the JSON
    assert sum("last_page_id" in v for v in page_vals) == 1
    assert all(v["during_time"] == 777 and v["ts"] == 1000 for v in page_vals)


def test_replayed_batch_replaces_its_output(spark):
    from daystream.plans import jobs
    from daystream.session import scratch_path
    out = scratch_path(spark, "replay")
    env = envelopes(spark, [rec(page=PAGE, start=START), rec(err={"a": 1})])
    jobs.process_log_batch(spark, env, out, 7)
    jobs.process_log_batch(spark, env, out, 7)          # replay of batch 7
    jobs.process_log_batch(spark, env, out, 8, persist=True)
    msgs = spark.read.parquet(f"{out}/topics")
    got = {(r.batch_id, r.topic): r["count"] for r in msgs.groupBy("batch_id", "topic")
           .count().collect()}
    assert got == {(7, R.PAGE_TOPIC): 1, (7, R.START_TOPIC): 1, (7, R.ERROR_TOPIC): 1,
                   (8, R.PAGE_TOPIC): 1, (8, R.START_TOPIC): 1, (8, R.ERROR_TOPIC): 1}
    ledger = jobs.read_ledger(spark, f"{out}/ledger").collect()
    assert [(r.partition, r.until_offset, r.batch_id) for r in ledger] == [(0, 2, 8)]
