import json
import math

from pyspark.sql import functions as F

from obsflow.schemas import MESSAGE_SCHEMA, RECORD_FIELDS
from obsflow.sources import messages


def _msgs(spark, values):
    rows = [(b"k", None if v is None else v.encode(), "t", 0, i, None) for i, v in enumerate(values)]
    return spark.createDataFrame(rows, MESSAGE_SCHEMA)


def test_parse_table(spark):
    good = {"city": "Paris", "temperature": 12.5, "humidity": 55, "timestamp": "2024-01-01T10:00:00+00:00"}
    values = [
        "not json",
        '{"city": "Paris", "temperature": 1',           # truncated
        "[1, 2, 3]",                                    # root array
        '{"city": "Paris", "humidity": 55.5}',         # wrong type -> field NULL
        '{"city": "Paris", "humidity": "55"}',
        '{"city": "Paris", "temperature": 1}',         # int into double -> 1.0
        '{"city": "Paris", "temperature": NaN}',
        '{"City": "Paris"}',                            # keys are case-sensitive
        json.dumps(dict(good, extra=1)),                # extra key ignored
        None,
    ]
    out = messages.parse_messages(_msgs(spark, values), keep=["offset"], with_corrupt=True) \
        .orderBy("offset").collect()
    assert out[0]["city"] is None and out[0]["is_malformed"]
    assert out[1]["city"] is None and out[1]["is_malformed"]
    assert all(out[2][f] is None for f in RECORD_FIELDS)
    assert out[3]["city"] == "Paris" and out[3]["humidity"] is None
    assert out[4]["humidity"] is None
    assert out[5]["temperature"] == 1.0
    assert math.isnan(out[6]["temperature"])
    assert out[7]["city"] is None
    assert out[8]["city"] == "Paris" and out[8]["humidity"] == 55 and out[8]["event_time"] is not None
    assert all(out[9][f] is None for f in RECORD_FIELDS)


def test_times(spark):
    vals = ['{"timestamp": "2024-01-01T10:00:00.123456+00:00"}', '{"timestamp": "2024-01-01T10:00:00+00:00"}',
            '{"timestamp": "bad"}', '{"timestamp": null}']
    out = messages.parse_messages(_msgs(spark, vals), keep=["offset"]).orderBy("offset") \
        .select(F.date_format("event_time", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("t")).collect()
    assert [r["t"] for r in out] == ["2024-01-01 10:00:00.123456", "2024-01-01 10:00:00.000000", None, None]


def test_encode_roundtrip_drops_null_keys(spark):
    from tests.conftest import rec
    df = spark.createDataFrame([rec(city="Rome", temperature=3.5, visibility=None,
                                    timestamp="2024-01-01T00:00:00+00:00")], messages.RECORD_SCHEMA)
    m = messages.encode_messages(df, time_col=None).first()
    assert m["key"] == b"Rome"
    assert "visibility" not in json.loads(m["value"].decode())
    back = messages.parse_messages(messages.encode_messages(df, time_col=None)).first()
    assert back["city"] == "Rome" and back["temperature"] == 3.5 and back["visibility"] is None


def test_payload_defaults_and_quarantine(spark):
    base = {"main": {"temp": 1.0, "feels_like": 0.0, "temp_min": 0.0, "temp_max": 2.0, "humidity": 50,
                     "pressure": 1000}, "wind": {"speed": 3.0}, "clouds": {"all": 10},
            "weather": [{"id": 800, "main": "Clear", "description": "clear sky"}]}
    rows = [
        (1, json.dumps(base)),                                   # absent deg/gust/visibility -> defaults
        (2, json.dumps(dict(base, visibility=None))),            # JSON null -> default too
        (3, json.dumps(dict(base, weather=[]))),                 # quarantined
        (4, json.dumps({k: v for k, v in base.items() if k != "main"})),  # quarantined
        (5, "garbage"),
    ]
    raw = spark.createDataFrame([(i, "Paris", "FR", p) for i, p in rows], "id int, city string, country string, payload string") \
        .withColumn("polled_at", F.to_timestamp(F.lit("2024-01-01 10:00:00")))
    good = messages.normalize_payload(raw).orderBy("id").collect()
    assert [r["id"] for r in good] == [1, 2]
    assert good[0]["wind_deg"] == 0 and good[0]["wind_gust"] == 0.0 and good[0]["visibility"] == 10000
    assert good[1]["visibility"] == 10000
    assert good[0]["weather_main"] == "Clear" and good[0]["timestamp"] == "2024-01-01T10:00:00.000000+00:00"
    bad = {r["id"]: r["reject_reason"] for r in messages.quarantined_payloads(raw).collect()}
    assert bad == {3: "missing weather", 4: "missing main", 5: "unparseable"}


def test_parse_runs_once_under_filters(spark):
    from obsflow.operators.quality import clean_records
    from obsflow.operators.windows import window_aggregates
    from obsflow.plans.explain import plan_text
    from obsflow.sources.tables import weather_view
    from tests.conftest import SF001
    msgs = messages.encode_messages(weather_view(spark, SF001))
    for df in (clean_records(messages.parse_messages(msgs)), window_aggregates(messages.parse_messages(msgs)),
               messages.normalize_payload(messages.encode_payloads(weather_view(spark, SF001)))):
        assert plan_text(df, "simple").count("from_json(") == 1
