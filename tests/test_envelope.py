from datetime import datetime

from snapline.operators.envelope import apply_types, decode_envelope, encode_envelope, split_malformed
from snapline.schemas import RECORD_FIELDS


def msgs(spark, values):
    return spark.createDataFrame([(v, datetime(2024, 1, 1)) for v in values], "value string, timestamp timestamp_ntz")


def test_malformed_rows_are_kept_all_null(spark):
    d = decode_envelope(msgs(spark, ["not json", "[]", "null", "{}", "", None]))
    rows = d.collect()
    assert len(rows) == 6
    for r in rows:
        assert r["kafka_timestamp"] == datetime(2024, 1, 1)
        assert all(r[f] is None for f in RECORD_FIELDS)
    good, bad = split_malformed(d)
    assert good.count() == 0 and bad.count() == 6


def test_wrong_types_null_others_survive(spark):
    rec = '{\\"stationcode\\":12,\\"capacity\\":\\"5\\",\\"ebike\\":5.7,\\"mechanical\\":99999999999,\\"numbikesavailable\\":3}'
    v = '{"dataset_id":"ds","request_timestamp":"2024-01-01T10:00:00+00:00","record":"' + rec + '"}'
    r = decode_envelope(msgs(spark, [v])).first()
    assert r["stationcode"] == "12"
    assert r["capacity"] is None and r["ebike"] is None and r["mechanical"] is None
    assert r["numbikesavailable"] == 3
    assert r["request_timestamp"] == datetime(2024, 1, 1, 10)


def test_roundtrip_exact(spark):
    from snapline.plans.derived import avail
    from tests.conftest import SF_SMALL
    a = avail(spark, SF_SMALL)
    back = decode_envelope(encode_envelope(a))
    cols = [c for c in back.columns]
    assert back.exceptAll(a.select(*cols)).count() == 0
    assert a.select(*cols).exceptAll(back).count() == 0


def test_apply_types(spark):
    from snapline.plans.derived import avail
    from tests.conftest import SF_SMALL
    t = apply_types(avail(spark, SF_SMALL))
    assert dict(t.dtypes)["is_installed"] == "boolean"
    assert dict(t.dtypes)["duedate"] == "timestamp_ntz"
    assert "request_date" in t.columns
