"""Offset ranges, ledger save/read and resuming from saved positions."""

from messages import envelopes

from daystream.operators import ledger


def test_ranges_save_read_resume(spark):
    env = envelopes(spark, ["x"] * 6, start_offset=10).unionByName(
        envelopes(spark, ["y"] * 3, partition=1, start_offset=0))
    r = {(x.partition, x.from_offset, x.until_offset)
         for x in ledger.offset_ranges(env).collect()}
    assert r == {(0, 10, 16), (1, 0, 3)}
    l1 = ledger.ledger_save(None, ledger.offset_ranges(env), "g", 1)
    # a later save replaces the listed partition even if it moves back
    back = spark.createDataFrame([("ODS_BASE_LOG", 0, 12)],
                                 "topic string, partition int, until_offset long")
    l2 = ledger.ledger_save(l1, back, "g", 2)
    got = {(x.partition, x.until_offset) for x in ledger.ledger_read(l2, "g", "ODS_BASE_LOG")
           .collect()}
    assert got == {(0, 12), (1, 3)}
    assert ledger.ledger_read(l2, "other", "ODS_BASE_LOG").count() == 0
    more = envelopes(spark, ["z"] * 20, start_offset=0)
    rest = ledger.read_from_offsets(more, l2, "g", "ODS_BASE_LOG")
    assert sorted(x.offset for x in rest.collect()) == list(range(12, 20))
    # no saved position: read from the beginning
    fresh = ledger.read_from_offsets(more, l2, "nobody", "ODS_BASE_LOG")
    assert fresh.count() == 20


def test_kafka_starting_offsets_from_ledger(spark):
    import json

    from daystream.sources.kafka import offsets_option
    saves = spark.createDataFrame(
        [("g", "T", 0, 5, 1), ("g", "T", 1, 7, 1), ("g", "T", 0, 9, 2), ("h", "T", 0, 1, 1)],
        "group_id string, topic string, partition int, until_offset long, batch_id long")
    current = ledger.latest(saves)
    assert json.loads(offsets_option(current, "g", "T")) == {"T": {"0": 9, "1": 7}}
    assert offsets_option(current, "nobody", "T") is None
