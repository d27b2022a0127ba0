"""Parser and dead-letter rule on hand-made records."""

import json

from messages import envelopes

from daystream.operators.parse import dead_letter, parse_log

COMMON = {"ar": "11", "ba": "acme", "ch": "web", "is_new": "1", "md": "A9",
          "mid": "dev-7", "os": "os 3", "uid": "u7", "vc": "0.9"}


def rec(**kw):
    r = {"common": COMMON, "ts": 1704067200000}
    r.update(kw)
    return json.dumps({k: v for k, v in r.items() if v is not None})


def reasons(spark, values):
    p = parse_log(envelopes(spark, values))
    return [r.dead_reason for r in p.orderBy("src_offset").collect()]


def test_dead_letter_reasons(spark):
    vals = [
        "",                                   # empty
        "   ",                                # blank
        None,                                 # null
        "not json",                           # corrupt
        '[{"a":1}]',                          # array, not object
        json.dumps({"ts": 1}),                # no common
        rec(common={"uid": "1"}),             # null mid
        rec(ts=None),                         # missing ts
        rec(ts="1.5"),                        # not a whole number
        rec(page={"page_id": "home"}),        # page without during_time
        rec(page="a string"),                 # string in place of object
        rec(err={"code": 1}, common=None, ts=None),  # error: forwarded whole
        rec(),                                # fine (neither branch)
    ]
    assert reasons(spark, vals) == [
        "empty", "empty", "empty", "corrupt", "corrupt", "missing_common", "missing_mid",
        "missing_ts", "missing_ts", "missing_during_time", "corrupt", None, None]


def test_lenient_coercions(spark):
    vals = [rec(ts="1704067200123", page={"page_id": "p", "during_time": " 12 ", "item": 7}),
            rec(ts=1704067200000) + " trailing garbage"]
    p = parse_log(envelopes(spark, vals)).orderBy("src_offset").collect()
    assert p[0].ts == 1704067200123 and p[0].dead_reason is None
    assert p[0].page.item == "7" and p[0].page.during_time == " 12 "
    # an object followed by garbage still parses (no corrupt marker)
    assert p[1].dead_reason is None and p[1].ts == 1704067200000


def test_empty_page_object_is_a_page(spark):
    p = parse_log(envelopes(spark, [rec(page={})])).collect()[0]
    assert p.page is not None
    assert p.dead_reason == "missing_during_time"


def test_dead_letter_keeps_text(spark):
    d = dead_letter(parse_log(envelopes(spark, ["not json"]))).collect()
    assert [(r.reason, r.value) for r in d] == [("corrupt", "not json")]
