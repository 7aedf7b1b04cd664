from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from tidemart.operators.validation import checked, is_iso8601, schema_drift
from tidemart.schemas import REQUIRED_FIELDS

GOOD = {
    "event_id": "e",
    "event_type": "order_created",
    "schema_version": "1.0",
    "event_ts": "2024-01-02T03:04:05Z",
    "source_system": "s",
    "order_id": "o",
    "payload": {"a": 1},
}


def without(*names):
    return {k: v for k, v in GOOD.items() if k not in names}


def text(obj) -> bytes:
    return json.dumps(obj).encode()


CASES = [
    (None, "null_message"),
    (b"\xff\xfe{}", "decode_error"),
    (b"not json", "invalid_json"),
    (b"", "invalid_json"),
    (b"[1]", "envelope_not_object"),
    (b"null", "envelope_not_object"),
    (b'"text"', "envelope_not_object"),
    (text(without("event_id", "payload")), "missing_required_fields: event_id,payload"),
    *[(text(without(f)), f"missing_required_fields: {f}") for f in REQUIRED_FIELDS],
    (text({**GOOD, "order_id": None}), None),
    (text({**GOOD, "payload": 5}), "payload_not_object"),
    (text({**GOOD, "payload": None}), "payload_not_object"),
    (text({**GOOD, "payload": [1]}), "payload_not_object"),
    (text({**GOOD, "payload": {}}), None),
    (text({**GOOD, "event_ts": "bad"}), "event_ts_not_iso8601"),
    (text({**GOOD, "event_ts": None}), "event_ts_not_iso8601"),
    (text({**GOOD, "event_ts": 20240102}), "event_ts_not_iso8601"),
    (text({**GOOD, "extra": {"deep": [1]}}), None),
    (json.dumps(GOOD, indent=2).encode(), None),
    (text({**GOOD, "payload": {"note": "größe\n}"}}), None),
]


@pytest.fixture(scope="module")
def verdicts(spark):
    df = spark.createDataFrame([(i, v) for i, (v, _) in enumerate(CASES)], "i int, value binary")
    return dict(checked(df).select("i", "error_reason").collect())


@pytest.mark.parametrize("i", range(len(CASES)))
def test_first_broken_rule_is_named(verdicts, i):
    assert verdicts[i] == CASES[i][1]


def test_strict_types_is_optional(spark):
    df = spark.createDataFrame([(text({**GOOD, "event_id": 7, "order_id": None}),)], "value binary")
    assert checked(df).first().error_reason is None
    assert checked(df, strict_types=True).first().error_reason == "wrong_type: event_id"


@pytest.mark.parametrize(
    "value,ok",
    [
        ("2024-01-02T03:04:05", True),
        ("2024-01-02 03:04:05", True),
        ("2024-01-02T03:04:05.123456Z", True),
        ("2024-01-02T03:04:05+00:00", True),
        ("2024-01-02T03:04:05-0300", True),
        ("2024-01-02", True),
        ("2024-01-02T03:04", True),
        ("2024-13-45", False),
        ("2024", False),
        ("02/01/2024", False),
        ("", False),
        (None, False),
    ],
)
def test_iso8601(spark, value, ok):
    df = spark.createDataFrame([(value,)], "v string")
    assert df.select(is_iso8601(F.col("v"))).first()[0] is ok


def test_schema_drift(spark):
    new = {**without("order_id"), "schema_version": "2.1", "colour": "red", "_kafka_offset": 3}
    df = spark.createDataFrame([(json.dumps(new),)], "text string")
    row = schema_drift(df).first()
    assert row.unknown_fields == ["colour"]
    assert "order_id" in row.missing_fields and "event_id" not in row.missing_fields
    assert row.major_changed is True


def test_payload_fields_have_the_types_of_their_topic(spark):
    import json

    from tidemart.operators.validation import payload_drift

    head = {"event_id": "e", "event_type": "t", "schema_version": "1.0", "event_ts": "2024-01-01T00:00:00Z", "source_system": "s", "order_id": "o"}
    cases = [
        ("payment_events", {"payment_value": 1.5, "payment_installments": 2, "payment_type": "x"}, None),
        ("payment_events", {"payment_value": 3, "payment_installments": None}, None),
        ("payment_events", {"payment_value": "3"}, "wrong_type: payload.payment_value"),
        ("payment_events", {"payment_value": 1e40}, "wrong_type: payload.payment_value"),
        ("payment_events", {"payment_installments": 2.5, "payment_type": 1}, "wrong_type: payload.payment_type,payload.payment_installments"),
        ("review_events", {"review_score": 3_000_000_000}, "wrong_type: payload.review_score"),
        ("review_events", {"review_score": [5], "payment_value": "other topic"}, "wrong_type: payload.review_score"),
        ("unknown_topic", {"review_score": [5]}, None),
    ]
    rows = [(t, json.dumps({**head, "payload": p}).encode(), n) for n, (t, p, _) in enumerate(cases)]
    df = spark.createDataFrame(rows, "topic string, value binary, n int")
    assert [r.error_reason for r in checked(df, strict_types=True).orderBy("n").collect()] == [reason for *_, reason in cases]
    assert {r.error_reason for r in checked(df).collect()} == {None}
    drift = {(r.topic, r.field, r.drift): r.messages for r in payload_drift(checked(df)).collect()}
    assert drift["payment_events", "payment_value", "retyped to STRING"] == 1 and drift["payment_events", "payment_value", "absent"] == 1
    assert drift["review_events", "payment_value", "unknown"] == 1 and drift["unknown_topic", "review_score", "unknown"] == 1
    assert ("payment_events", "payment_installments", "retyped to BIGINT") not in drift


def test_messages_of_a_topic_without_contract_are_told_plain(spark):
    from tidemart.operators.validation import plainly_typed

    envelope = {"event_id": "e", "event_type": "t", "schema_version": "1.0", "event_ts": "2024-01-01", "source_system": "s", "order_id": None, "payload": {"k": 1}}
    cases = [
        ({"channel": "web"}, True),
        ({"channel": 1.5, "payload": {}}, True),
        ({"event_id": 5}, False),
        ({"trace_id": True}, False),
        ({"channel": {"order_id": "nested"}, "order_id": 1}, False),
        ({"payload": {"a: STRING>, order_id": "x"}, "seller_id": 2}, False),
        ({"a: STRING, event_id": "x", "event_id": 1}, False),
    ]
    rows = [(k, json.dumps({**envelope, **more})) for k, (more, _) in enumerate(cases)]
    message = F.parse_json("text")
    df = spark.createDataFrame(rows, "id int, text string").withColumn("topic", F.lit("click_events"))
    found = df.select("id", plainly_typed(message, F.schema_of_variant(message), F.col("topic")).alias("plain"), "topic", F.col("text").alias("value"))
    assert {r.id: r.plain for r in found.collect()} == {k: plain for k, (_, plain) in enumerate(cases)}
    reasons = {r.id: r.error_reason for r in checked(found, strict_types=True).collect()}
    assert reasons == {0: None, 1: None, 2: "wrong_type: event_id", 3: "wrong_type: trace_id", 4: "wrong_type: order_id", 5: "wrong_type: seller_id", 6: "wrong_type: event_id"}


def test_payload_drift_reads_the_messages_once(spark, tmp_path):
    from tidemart.operators.validation import payload_drift

    texts = ['{"payload":{}}', '{"payload":{"review_id":null,"review_score":"5"}}', '{"payload":[1]}', "not json"]
    rows = [("review_events", t) for t in texts] + [("other", '{"payload":{"x":1}}'), ("other", '{"payload":{}}'), (None, '{"payload":{"x":1}}')]
    spark.createDataFrame(rows, "topic string, text string").write.parquet(str(tmp_path / "messages"))
    drift = payload_drift(spark.read.parquet(str(tmp_path / "messages")))
    fields = ("review_created_ts", "review_answer_ts", "review_comment_title")
    assert {tuple(r) for r in drift.collect()} == {
        *(("review_events", f, "absent", 2) for f in fields),
        ("review_events", "review_id", "absent", 1),
        ("review_events", "review_score", "absent", 1),
        ("review_events", "review_score", "retyped to STRING", 1),
        ("other", "x", "unknown", 1),
        (None, "x", "unknown", 1),
    }
    assert drift._jdf.queryExecution().optimizedPlan().toString().count("Relation [") == 1


def test_a_plain_message_breaks_no_rule_and_needs_no_parser(spark):
    from tidemart.operators.validation import plainly_written

    head = '"event_id":"e","event_type":"t","schema_version":"1.0","event_ts":"2024-01-02T03:04:05"'
    tail = '"source_system":"s","source_table":null,"order_id":"o","seller_id":"a\u00e9\u20ac"'
    body = '"payment_sequential":1,"payment_type":"x","payment_installments":null,"payment_value":-12.50,"payment_status":"ok"'
    message = lambda payload=body, head=head, tail=tail: f'{{{head},{tail},"payload":{{{payload}}}}}'
    plain = [message(), message(""), message('"payment_value":0'), message('"payment_type":null,"payment_status":"}"'), message(head=head + ',"ingestion_hint_ts":null')]
    others = [  # with the reason that the rules find
        (message('"payment_type":"a\\n"'), None),
        (message(body + ',"coupon":1'), None),
        (message('"payment_value":1e2'), None),
        (message('"payment_status":"ok","payment_type":"x"'), None),
        (" " + message(), None),
        (message().replace(":", ": ", 1), None),
        (message('"payment_sequential":999999999999'), "wrong_type: payload.payment_sequential"),
        (message('"payment_value":12345678901234567.5'), "wrong_type: payload.payment_value"),
        (message('"payment_type":1'), "wrong_type: payload.payment_type"),
        (message(head=head.replace('"e"', "7")), "wrong_type: event_id"),
        (message(head=head.replace("T", "x")), "event_ts_not_iso8601"),
        (message(tail='"source_system":"s"'), "missing_required_fields: order_id"),
        (message('"payment_type":"x","payment_type":"y"'), "invalid_json"),
        (message(',"payment_type":"x"'), "invalid_json"),
        (message('"payment_type":"x",'), "invalid_json"),
        (message('"payment_type":"a\tb"'), "invalid_json"),
        (message('"payment_value":01'), "invalid_json"),
        (message()[:-1], "invalid_json"),
        (message().replace(',"payload"', ',"event_ts":"2024-01-02T03:04:05","payload"'), "invalid_json"),
    ]
    rows = [(n, text, "payment_events") for n, text in enumerate(plain + [t for t, _ in others])]
    df = spark.createDataFrame(rows, "n int, value string, topic string").withColumn("value", F.col("value").cast("binary"))
    told = {r.n: r.plain for r in df.select("n", plainly_written(F.col("value").cast("string"), F.col("topic")).alias("plain")).collect()}
    assert [n for n, yes in sorted(told.items()) if yes] == list(range(len(plain)))
    judged = {r.n: r for r in checked(df, strict_types=True, keep=True).collect()}
    assert [judged[n].error_reason for n in sorted(judged)] == [None] * len(plain) + [reason for _, reason in others]
    assert {judged[n]._event_ts for n in range(len(plain))} == {"2024-01-02T03:04:05"}
    # the rules alone, as for a topic without a contract, find nothing wrong with a plain message
    free = checked(df.where(F.col("n") < len(plain)).withColumn("topic", F.lit("other")), strict_types=True, keep=True).collect()
    assert {(r.error_reason, r._plain, r._event_ts) for r in free} == {(None, False, "2024-01-02T03:04:05")}
