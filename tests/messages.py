"""Hand-made messages."""


def envelopes(spark, values, topic="ODS_BASE_LOG", start_offset=0, partition=0, ts_ms=None):
    """Envelope rows for hand-made message texts, in order."""
    import datetime as _dt
    rows = []
    for n, v in enumerate(values):
        ts = _dt.datetime(2024, 1, 1, tzinfo=_dt.timezone.utc) + _dt.timedelta(
            milliseconds=(ts_ms[n] if ts_ms else n))
        rows.append((None, v, topic, partition, start_offset + n, ts))
    from daystream import schemas
    return spark.createDataFrame(rows, schemas.ENVELOPE)
