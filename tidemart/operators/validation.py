"""Envelope validation: the first broken rule names the dead-letter reason."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidemart.schemas import ENVELOPE, ISO_8601, OPTIONAL_FIELDS, PAYLOAD_FIELDS, REQUIRED_FIELDS

# Shapes accepted besides the contract's: a bare date, or a time without seconds.
LENIENT_ISO = r"^\d{4}-\d{2}-\d{2}([T ]\d{2}(:\d{2}(:\d{2}(\.\d+)?)?)?(Z|[+-]\d{2}:?\d{2})?)?$"


def is_iso8601(text: Column) -> Column:
    lenient = text.rlike(LENIENT_ISO) & F.try_to_timestamp(text).isNotNull()
    return F.coalesce(text.rlike(ISO_8601) | lenient, F.lit(False))


def _kind(message: Column, path: str) -> Column:
    return F.schema_of_variant(F.try_variant_get(message, path, "variant"))


def _whole(kind: Column) -> Column:
    return kind == "BIGINT"


def _number(kind: Column) -> Column:
    return _whole(kind) | kind.startswith("DECIMAL") | kind.startswith("DOUBLE")


def fits(message: Column, path: str, wanted: str) -> Column:
    """Whether the value at ``path`` is absent, null, or of the wanted type without loss."""
    kind = _kind(message, path)
    if wanted == "string":
        right = kind == "STRING"
    else:
        right = (_whole if wanted in ("int", "bigint") else _number)(kind) & F.try_variant_get(message, path, wanted).isNotNull()
    return F.coalesce((kind == "VOID") | right, kind.isNull())


def payload_types(topic: str) -> dict[str, str]:
    """The contract's types of a topic's payload fields."""
    return {f.name: f.dataType.simpleString() for f in StructType.fromDDL(PAYLOAD_FIELDS[topic])}


def wrong_types(message: Column, topic: Column) -> Column:
    """Names of the envelope fields that are no text and of the payload fields that are not of their topic's types."""
    texts = [f for f in REQUIRED_FIELDS + OPTIONAL_FIELDS if f not in ("payload", "event_ts")]
    of = lambda types, prefix: F.array(*[F.when(~fits(message, f"$.{prefix}{name}", kind), F.lit(prefix + name)) for name, kind in types.items()])
    payload = F.array().cast("array<string>")
    for known in PAYLOAD_FIELDS:
        payload = F.when(topic == known, of(payload_types(known), "payload.")).otherwise(payload)
    return F.filter(F.concat(of(dict.fromkeys(texts, "string"), ""), payload), lambda f: f.isNotNull())


def plainly_typed(message: Column, kinds: Column, topic: Column) -> Column:
    """Whether a message has fields of the contract alone (or plain ones, in topics without one), all of the right types: told from the text of its
    schema and a look at its numbers.  What is not plainly right goes through :func:`wrong_types`.
    """
    texts = [f for f in REQUIRED_FIELDS + OPTIONAL_FIELDS if f != "payload"]
    shape = {"string": "STRING", "int": "BIGINT", "bigint": "BIGINT"}
    # A topic without a contract for its payload has types for the envelope alone; other fields of one value may stand
    # between.  Names that are no plain words are quoted in the text, so no name can pass for another field.
    some = r"\w+: [A-Z]+(?:\(\d+,\d+\))?"
    envelope = f"(?:{'|'.join(texts)}): (?:STRING|VOID)|payload: OBJECT<(?:{some}(?:, |(?=>)))*>|(?!(?:{'|'.join(REQUIRED_FIELDS + OPTIONAL_FIELDS)}): ){some}"
    free = kinds.rlike(f"^OBJECT<(?:(?:{envelope})(?:, |(?=>)))*>$") & ~topic.isin(*PAYLOAD_FIELDS)

    def fields(kinds: dict[str, str]) -> str:
        return "".join(rf"(?:{name}: (?:{kind})(?:, |(?=>)))?" for name, kind in sorted(kinds.items()))

    right = free
    for known in PAYLOAD_FIELDS:
        types = payload_types(known)
        numbers = {f"$.payload.{name}": kind for name, kind in types.items() if kind != "string"}
        payload = fields({name: shape.get(kind, r"BIGINT|DOUBLE|DECIMAL\(\d+,\d+\)") + "|VOID" for name, kind in types.items()})
        whole = fields({**dict.fromkeys(texts, "STRING|VOID"), "payload": f"OBJECT<{payload}>"})
        plain = kinds.rlike(f"^OBJECT<{whole}>$")
        for path, kind in numbers.items():
            plain = plain & (F.try_variant_get(message, path, kind).isNotNull() | F.try_variant_get(message, path, "string").isNull())
        right = F.when(topic == known, plain).otherwise(right)
    return F.coalesce(right, F.lit(False))


PLAIN, STAMP = "_plain", "_event_ts"
#: A longer message is left to the parser, which has a limit of its own.
PLAIN_BYTES = 1 << 20


def _written(kind: str) -> str:
    """Pattern of the JSON values that are of a type beyond doubt: texts without escapes, numbers of few digits."""
    fraction = r"(?:\.\d{1,10})?"
    breaks = "".join(f"\\x{c:02x}" for c in range(32))  # one by one they are looked up in a table, as a range compared
    values = {
        "string": rf'"[^"\\{breaks}]*+"',
        "int": r"-?(?:0|[1-9]\d{0,8})",
        "bigint": r"-?(?:0|[1-9]\d{0,16})",
        "double": r"-?(?:0|[1-9]\d{0,14})" + fraction,
        "decimal(18,2)": r"-?(?:0|[1-9]\d{0,14})" + fraction,
        "decimal(10,2)": r"-?(?:0|[1-9]\d{0,6})" + fraction,
    }
    return f"(?:null|{values[kind]})" if kind in values else "null"


def plainly_written(text: Column, topic: Column) -> Column:
    """Whether a message is written as its topic's contract lists it: the required fields and any of the others in their order, of
    the right types and without blanks, escapes or anything else.  Such a text is valid JSON that breaks no rule, whoever wrote
    it, and needs no parser; all others are judged rule by rule.
    """
    stamp = ISO_8601.strip("^$").replace("(", "(?:")
    fields = [f.split()[0] for f in ENVELOPE.split(", ")]
    of = lambda name: f'"{name}":' + (f'"{stamp}"' if name == "event_ts" else _written("string"))
    first, *others = [of(f) if f in REQUIRED_FIELDS else f"(?:,{of(f)})?" for f in fields]
    envelope = first + "".join(o if o.startswith("(") else f",{o}" for o in others)
    right = F.lit(False)
    for known in PAYLOAD_FIELDS:
        payload = "".join(rf'(?:(?:(?<=\{{)|(?<!\{{),)"{name}":{_written(kind)})?' for name, kind in payload_types(known).items())
        right = F.when(topic == known, text.rlike(rf'^\{{{envelope},"payload":\{{{payload}\}}\}}\z')).otherwise(right)
    return F.coalesce((F.octet_length(text) <= PLAIN_BYTES) & right, F.lit(False))


def checked(df: DataFrame, value: str = "value", strict_types: bool = False, keep: bool = False) -> DataFrame:
    """Adds ``text`` (the decoded message) and ``error_reason`` (NULL when valid).

    Rules in order: null message, not UTF-8, not JSON, not an object, required
    keys missing (a present null passes), payload not an object, event_ts not
    ISO 8601.  ``strict_types`` adds the contract's rule on data types: envelope fields
    are strings, payload fields have the types of their topic (column ``topic``).
    ``keep`` also leaves PLAIN (:func:`plainly_written`) and STAMP (the text of event_ts), so that nobody reads a message again for them.
    """
    raw = F.col(value)
    text = raw.cast("string")
    readable = F.when(F.is_valid_utf8(text), text)
    topic = F.col("topic") if "topic" in df.columns else F.lit("")
    plain, message, kinds, stamp = F.col(PLAIN), F.col("_v"), F.col("_kinds"), F.col(STAMP)
    # Columns of their own, so that each is told once for all rules.
    parsed = df.withColumn("text", readable).withColumn(PLAIN, plainly_written(F.col("text"), topic))
    parsed = parsed.withColumn("_v", F.when(~plain, F.try_parse_json("text")))
    written = F.regexp_extract("text", '"event_ts":"([^"]*)"', 1)  # a plain message has these letters once
    told = F.when(plain, written).otherwise(F.try_variant_get(message, "$.event_ts", "string"))
    parsed = parsed.withColumns({"_kinds": F.schema_of_variant(message), STAMP: told})
    missing = F.array_except(F.array(*[F.lit(f) for f in REQUIRED_FIELDS]), F.json_object_keys("text"))
    rules = (
        F.when(plain, F.lit(None).cast("string"))
        .when(raw.isNull(), "null_message")
        .when(F.col("text").isNull(), "decode_error")
        .when(message.isNull(), "invalid_json")
        .when(~kinds.startswith("OBJECT"), "envelope_not_object")
        .when(F.size(missing) > 0, F.concat(F.lit("missing_required_fields: "), F.array_join(missing, ",")))
        .when(~F.coalesce(_kind(message, "$.payload").startswith("OBJECT"), F.lit(False)), "payload_not_object")
        .when((F.coalesce(_kind(message, "$.event_ts"), F.lit("")) != "STRING") | ~is_iso8601(stamp), "event_ts_not_iso8601")
    )
    if strict_types:
        wrong = F.when(plainly_typed(message, kinds, topic), F.array().cast("array<string>")).otherwise(wrong_types(message, topic))
        rules = rules.when(F.size(wrong) > 0, F.concat(F.lit("wrong_type: "), F.array_join(wrong, ",")))
    return parsed.withColumn("error_reason", rules).drop("_v", "_kinds", *(() if keep else (PLAIN, STAMP)))


def schema_drift(df: DataFrame, text: str = "text", supported_major: str = "1") -> DataFrame:
    """Unknown and absent optional envelope fields and the major version, per message."""
    known = F.array(*[F.lit(f) for f in REQUIRED_FIELDS + OPTIONAL_FIELDS])
    keys = F.filter(F.json_object_keys(text), lambda k: ~k.startswith("_"))
    version = F.get_json_object(text, "$.schema_version")
    return (
        df.withColumn("unknown_fields", F.array_sort(F.array_except(keys, known)))
        .withColumn("missing_fields", F.array_except(known, keys))
        .withColumn("major_changed", F.split(version, r"\.")[0] != supported_major)
    )


def payload_drift(df: DataFrame, text: str = "text") -> DataFrame:
    """Per topic and payload field: messages in which it is unknown, absent, or of another type than the contract's.

    ``df`` has ``topic`` and the message text.  A null value is neither absent nor of a wrong
    type.  Fields of a message become rows and are counted before the shuffle.
    """
    payload = F.try_variant_get(F.try_parse_json(text), "$.payload", "map<string, variant>")
    # An entry without a name stands for the message itself, so that one reading counts both.  Messages without a payload
    # have no entry at all; a filter or an inner generator here would parse every text once more for each condition.
    entries = F.expr("concat(array(struct(cast(null as string) as field, 'OBJECT' as kind)), transform(map_entries(payload), e -> struct(e.key as field, schema_of_variant(e.value) as kind)))")
    found = df.select("topic", payload.alias("payload")).select("topic", F.inline_outer(entries).alias("field", "kind"))
    kinds = found.groupBy("topic", "field", "kind").agg(F.count(F.lit(1)).alias("messages"))
    rows = [(t, f, kind) for t in PAYLOAD_FIELDS for f, kind in payload_types(t).items()]
    contract = df.sparkSession.createDataFrame(rows, "topic string, field string, wanted string")
    kind, wanted = F.col("kind"), F.col("wanted")
    right = F.when(wanted == "string", kind == "STRING").when(wanted.isin("int", "bigint"), _whole(kind)).otherwise(_number(kind))
    expected = contract.select("topic", "field", F.lit(None).cast("string").alias("kind"), F.lit(0).cast("bigint").alias("messages"), F.lit(True).alias("expected"))
    # The windows run over counts: a row for each field and kind of a topic.
    every, same = Window.partitionBy("topic"), Window.partitionBy("topic", "field")
    counted = (
        kinds.withColumn("expected", F.lit(False)).unionByName(expected)
        .withColumn("all_messages", F.sum(F.when(F.col("field").isNull() & kind.isNotNull(), F.col("messages"))).over(every))
        .withColumn("present", F.sum("messages").over(same))
        .where("field is not null")
        .join(F.broadcast(contract), ["topic", "field"], "left")
    )
    drift = (
        F.when(F.col("expected"), F.lit("absent"))
        .when(wanted.isNull(), "unknown")
        .when((kind != "VOID") & ~right, F.concat(F.lit("retyped to "), kind))
    )
    messages = F.when(F.col("expected"), F.col("all_messages") - F.col("present")).otherwise(F.col("messages"))
    judged = counted.select("topic", "field", drift.alias("drift"), messages.alias("messages")).where("drift is not null and messages > 0")
    return judged.groupBy("topic", "field", "drift").agg(F.sum("messages").alias("messages"))
