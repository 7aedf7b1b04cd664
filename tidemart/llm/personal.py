"""Personal data in texts: regular expressions propose spans, checksums confirm them, nearby words adjust their score.

Each kind proposes its leftmost non-overlapping matches.  A card number must pass
the Luhn check, a bank account number (iban) the mod-97 check, the parts of an ip are at most 255; what
fails is dropped.  A span scores the points of its kind and ``CONTEXT_POINTS`` more if one
of the kind's context words stands within ``NEAR`` characters of it, reaching no further than the
neighbouring proposals of its kind.  The kinds of ``BASE`` are found whatever their
score, the others need ``ENOUGH``.

All of it is Spark expressions over one row, no shuffle.  Positions follow from the
lengths of matches and of the pieces between them, added up in two steps so that the
work stays near linear in the number of proposals.  The patterns never try a run of characters from
each of its places: an address starts where its run of characters starts, so a word of a
million letters costs a million steps.

A null text has no spans, nor has an empty one.  Long texts are read whole; of the
text between proposals only its length and ends are kept.  Rows are judged one by one, so
repeated rows and ids give equal results; a null id passes through.  An empty table gives an empty
result.  Further columns pass through ``found`` unless they are named ``spans``, and
are never read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Kinds in the order of the digest.
BASE = ("email", "ip", "card", "phone")
MORE = ("iban", "ssn", "local")

_NAME = "A-Za-z0-9._%+-"
PATTERNS = {
    "email": rf"(?:(?<![{_NAME}])|\G)[{_NAME}]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    # a whole chain of digits, one space or hyphen between them at most
    "card": r"(?<![0-9])(?<![0-9][\x20-])[0-9](?:[\x20-]?[0-9]){12,18}+(?![\x20-]?[0-9])",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    "iban": r"[A-Z][A-Z][0-9][0-9](?:\x20?[A-Z0-9][A-Z0-9][A-Z0-9][A-Z0-9]){2,7}(?:\x20?[A-Z0-9]{1,3})?",
    "ssn": r"[0-9]{3}-[0-9]{2}-[0-9]{4}",
    "local": r"(?:\([0-9]{3}\)\x20?|[0-9]{3}[.-])[0-9]{3}[.-][0-9]{4}",
}
#: What a text must hold for a kind to be worth a search.
NEEDED = {"email": "@", "ip": "[0-9]", "card": "[0-9]", "phone": r"\+", "iban": "[A-Z][A-Z][0-9][0-9]", "ssn": "-[0-9][0-9]-", "local": "[0-9][.-][0-9]"}
#: Points of a confirmed span, in hundredths.
POINTS = {"email": 90, "ip": 60, "card": 70, "phone": 60, "iban": 70, "ssn": 40, "local": 40}
CONTEXT = {
    "email": "mail|contact|kontakt|correo|courriel",
    "ip": "ip|address|host|server|login",
    "card": "card|visa|mastercard|karte|carte|tarjeta|payment",
    "phone": "phone|tel|call|mobile|fax|whatsapp",
    "iban": "iban|account|bank|konto|compte|cuenta",
    "ssn": "ssn|social",
    "local": "phone|tel|call|mobile|fax|whatsapp|handy",
}
CONTEXT_POINTS = 30
ENOUGH = 60
NEAR = 48
#: Characters that may not touch a span of these kinds, before and after it.
TOUCHING = {"iban": ("[A-Za-z0-9]$", "^[A-Za-z0-9]"), "ssn": ("[A-Za-z0-9-]$", "^[A-Za-z0-9-]"), "local": (r"([A-Za-z0-9(.-]|\+[0-9]{0,3}[\x20.-]{0,2})$", "^[A-Za-z0-9-]")}
_STEP = 256


def digits(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")


def luhn(number: Column) -> Column:
    """Whether a text of digits passes: every second digit from the right is doubled, 9 taken off above 9."""
    place = F.sequence(F.lit(1), F.length(number))

    def worth(k: Column) -> Column:
        d = F.substring(number, k, F.lit(1)).cast("int")
        doubled = (F.length(number) - k) % 2 == 1
        return F.when(doubled, F.when(d > 4, 2 * d - 9).otherwise(2 * d)).otherwise(d)

    return F.aggregate(place, F.lit(0), lambda total, k: total + worth(k)) % 10 == 0


def mod97(account: Column) -> Column:
    """Whether an account number without spaces passes: its first four characters moved to the end, letters as 10 to 35."""
    turned = F.concat(F.substring(account, F.lit(5), F.length(account)), F.substring(account, 1, 4))

    def add(rest: Column, k: Column) -> Column:
        code = F.ascii(F.substring(turned, k, F.lit(1)))
        return F.when(code < 65, rest * 10 + code - 48).otherwise(rest * 100 + code - 55) % 97

    return F.aggregate(F.sequence(F.lit(1), F.length(turned)), F.lit(0), add) == 1


def confirmed(kind: str, match: Column) -> Column:
    """The part of a match that its check confirms; null if none."""
    if kind == "ip":
        small = F.forall(F.split(match, r"\."), lambda p: p.rlike("^0*([0-9]{0,2}|1[0-9][0-9]|2[0-4][0-9]|25[0-5])$"))
        return F.when(small, match)
    if kind == "card":
        return F.when(luhn(digits(match)), match)
    if kind == "phone":
        return F.when(F.length(digits(match)).between(9, 15), match)
    if kind == "iban":  # words in capitals may follow the number: try without the last group or two
        shorter = F.regexp_replace(match, r"\x20[^\x20]*$", "")
        shortest = F.regexp_replace(shorter, r"\x20[^\x20]*$", "")
        passing = lambda m: F.length(F.replace(m, F.lit(" "), F.lit(""))).between(15, 34) & mod97(F.replace(m, F.lit(" "), F.lit("")))
        return F.coalesce(*[F.when(passing(m), m) for m in (match, shorter, shortest)])
    return match


def running(steps: Column) -> Column:
    """For each number the sum of those before it, made by blocks: copying grows with the square of a block only."""
    whole = F.array().cast("array<int>")

    def sums(block: Column, begin: Column) -> Column:
        zero = F.struct(begin.alias("at"), whole.alias("out"))
        add = lambda a, x: F.struct((a["at"] + x).alias("at"), F.array_append(a["out"], a["at"]).alias("out"))
        return F.aggregate(block, zero, add)["out"]

    numbers = F.sequence(F.lit(0), F.floor((F.size(steps) - 1) / F.lit(_STEP)).cast("int"))
    blocks = F.transform(numbers, lambda b: F.slice(steps, b * _STEP + 1, _STEP))
    zero = F.struct(F.lit(0).alias("at"), F.array().cast("array<array<int>>").alias("out"))
    total = lambda block: F.aggregate(block, F.lit(0), lambda a, x: a + x)
    joined = F.aggregate(
        blocks, zero, lambda a, block: F.struct((a["at"] + total(block)).alias("at"), F.array_append(a["out"], sums(block, a["at"])).alias("out"))
    )
    return F.when(F.size(steps) > 0, F.flatten(joined["out"])).otherwise(whole)


GAPS = "array<struct<n: int, ending: string, beginning: string>>"


def proposals(kind: str, text: Column) -> tuple[Column, Column]:
    """All matches of a kind, and length and ends of the pieces between them."""
    worth = text.rlike(NEEDED[kind])
    matches = F.regexp_extract_all(text, F.lit(PATTERNS[kind]), F.lit(0))
    ends = lambda p: F.struct(F.length(p).alias("n"), F.right(p, F.lit(NEAR)).alias("ending"), F.left(p, F.lit(NEAR)).alias("beginning"))
    gaps = F.transform(F.split(text, PATTERNS[kind], -1), ends)
    return F.when(worth, matches).otherwise(F.array().cast("array<string>")), F.when(worth, gaps).otherwise(F.array().cast(GAPS))


def begins(matches: Column, gaps: Column) -> Column:
    """Where the piece before each match begins."""
    return running(F.transform(matches, lambda m, k: F.get(gaps, k)["n"] + F.length(m)))


def spans(kind: str, matches: Column, gaps: Column, begun: Column, enough: int) -> Column:
    """The confirmed spans of a kind in order: kind, start, end (exclusive, in code points) and score.

    ``begun`` must be a column of its own, as an expression would be worked out anew for every match.
    """

    def span(m: Column, k: Column) -> Column:
        before, after = F.get(gaps, k), F.get(gaps, k + 1)
        start = F.get(begun, k) + before["n"]
        sure = confirmed(kind, m)
        near = F.lower(F.concat(before["ending"], F.lit(" "), after["beginning"])).rlike(rf"\b({CONTEXT[kind]})")
        if kind in TOUCHING:
            touched = before["ending"].rlike(TOUCHING[kind][0]) | ((F.length(sure) == F.length(m)) & after["beginning"].rlike(TOUCHING[kind][1]))
            sure = F.when(~touched, sure)
        score = F.lit(POINTS[kind]) + F.when(near, CONTEXT_POINTS).otherwise(0)
        return F.struct(F.lit(kind).alias("kind"), start.alias("start"), (start + F.length(sure)).alias("end"), F.least(score, F.lit(100)).alias("score"))

    found = F.filter(F.transform(matches, span), lambda s: s["end"].isNotNull())
    return found if kind in BASE else F.filter(found, lambda s: s["score"] >= enough)


def found(docs: DataFrame, enough: int = ENOUGH, kinds: tuple[str, ...] = (*BASE, *MORE)) -> DataFrame:
    """``docs`` with ``spans``: all spans as (kind, start, end, score), by kind, then start."""
    own = [c for c in docs.columns if c != "spans"]
    row = docs.select(F.struct(*own).alias("row"), F.coalesce("text", F.lit("")).alias("body"))
    proposed = row.select("row", *[c.alias(f"{name}_{kind}") for kind in kinds for name, c in zip(("match", "gap"), proposals(kind, F.col("body")))])
    of = lambda kind: (F.col(f"match_{kind}"), F.col(f"gap_{kind}"))
    begun = proposed.select("*", *[begins(*of(kind)).alias(f"begun_{kind}") for kind in kinds])
    placed = begun.select("row", *[spans(kind, *of(kind), F.col(f"begun_{kind}"), enough).alias(kind) for kind in kinds])
    return placed.select("row.*", F.concat(*[F.col(kind) for kind in kinds]).alias("spans"))


def listed(of: Column) -> Column:
    """Spans as ``kind:start:end``, joined by commas."""
    return F.array_join(F.transform(of, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def digest(docs: DataFrame, enough: int = ENOUGH) -> DataFrame:
    """Per row: how many spans of each base kind, the hash of their list, and the list of all spans."""
    spanned = found(docs.select("doc_id", "text"), enough)
    of = lambda *kinds: F.filter("spans", lambda s: s["kind"].isin(*kinds))
    return spanned.select(
        "doc_id",
        *[F.size(of(kind)).cast("long").alias(f"n_{kind}") for kind in BASE],
        F.sha2(listed(of(*BASE)), 256).alias("base_sha256"),
        listed(F.col("spans")).alias("spans"),
    )


def masked(docs: DataFrame, enough: int = ENOUGH) -> DataFrame:
    """``docs`` with each span of its text replaced by its kind in brackets; of overlapping spans the first by start stays."""
    spanned = found(docs, enough)
    ordered = F.array_sort(F.transform("spans", lambda s: F.struct(s["start"], s["end"], s["kind"])))
    zero = F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("out"))

    def put(a: Column, s: Column) -> Column:
        kept_text = F.substring(F.col("text"), a["at"] + 1, s["start"] - a["at"])
        more = F.concat(a["out"], F.array(kept_text, F.concat(F.lit("["), s["kind"], F.lit("]"))))
        return F.when(s["start"] < a["at"], a).otherwise(F.struct(s["end"].alias("at"), more.alias("out")))

    whole = F.aggregate(ordered, zero, put, lambda a: F.concat(F.array_join(a["out"], ""), F.substring(F.col("text"), a["at"] + 1, F.length("text"))))
    return spanned.select(*[whole.alias("text") if c == "text" else F.col(c) for c in docs.columns if c != "spans"])
