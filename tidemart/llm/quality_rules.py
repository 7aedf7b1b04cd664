"""Quality rules whose cutoffs are set by risk control on labelled holdouts.

Each rule measures one thing per document.  For every rule, stratum and candidate
cutoff, the labelled good documents of the stratum that the rule would reject are
counted; the cutoff may be used if an exact binomial test rejects the hypothesis
that more than ``risk / rules`` of the good documents fall to it.  The level is
shared among all rules, strata and candidates (Bonferroni), so with probability
``1 - error`` no stratum loses more than ``risk`` of its good documents to all
rules together.  The lowest usable cutoff is taken; a stratum with too few labels
has none and the rule does not fire there.

All measures are Spark expressions over the whole text.  Words repeat if an
8-word window of theirs occurs twice in the text; windows are compared by a
64-bit hash.  Null and empty texts have no words and zero measures.  A null
stratum is a stratum of its own.  Of repeated label rows, a good one counts once.
Rows that repeat an id are judged one by one.  Extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemart.llm.scratch import kept

WORD = r"[^\x20\x09-\x0D]+"
WINDOW = 8
#: Rules as (name, measure per word in millionths); higher is worse.
RULES = {
    "symbols": "1000000 * n_symbols div greatest(n_words, 1)",
    "repeats": "1000000 * n_repeat_words div greatest(n_words, 1)",
    "capitals": "1000000 * n_capitals div greatest(word_chars, 1)",
    "doubles": "1000000 * n_doubles div greatest(n_words, 1)",
    "lines": "1000000 * n_dup_lines div greatest(n_lines, 1)",
}
#: Candidate cutoffs of every rule, fixed before any label is seen.
CUTOFFS = tuple(1_000_000 * k // 20 for k in range(1, 20))


def measures(docs: DataFrame, *also: str) -> DataFrame:
    """Whole-text measures of each row of ``docs`` (doc_id, text), and the columns named in ``also``."""
    text = F.coalesce("text", F.lit(""))
    base = docs.select(
        "doc_id",
        *also,
        F.regexp_extract_all(text, F.lit(WORD), F.lit(0)).alias("words"),
        F.length(F.translate(text, " \t\n\x0b\x0c\r", "")).cast("long").alias("word_chars"),
        (F.length(text) - F.length(F.translate(text, "#*$%&|<>", ""))).cast("long").alias("n_symbols"),
        (F.length(text) - F.length(F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", ""))).cast("long").alias("n_capitals"),
        F.filter(F.split(text, "\n", -1), lambda x: x.rlike(r"[^\x20\x09-\x0D]")).alias("lines"),
    )
    n = F.size("words")
    hashed = base.select(
        "doc_id",
        *also,
        n.cast("long").alias("n_words"),
        "word_chars",
        "n_symbols",
        "n_capitals",
        F.size("lines").cast("long").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.expr("size(filter(words, (w, i) -> i > 0 and w = words[i - 1]))").cast("long").alias("n_doubles"),
        F.when(n >= WINDOW, F.expr(f"transform(sequence(1, size(words) - {WINDOW - 1}), i -> xxhash64(slice(words, i, {WINDOW})))"))
        .otherwise(F.array().cast("array<bigint>"))
        .alias("windows"),
    )
    # positions of windows that occur twice: in (hash, position) order a neighbour has the same hash
    placed = "array_sort(transform(windows, (h, i) -> struct(h as h, i as i)))"
    counted = hashed.withColumn("placed", F.when(F.size(F.array_distinct("windows")) < F.size("windows"), F.expr(placed)))
    twice = (
        "array_sort(transform(filter(placed, (x, k) -> (k > 0 and x.h = placed[k - 1].h)"
        " or (k < size(placed) - 1 and x.h = placed[k + 1].h)), x -> x.i))"
    )
    spans = counted.withColumn("twice", F.when(F.col("placed").isNotNull(), F.expr(twice)))
    # each such window covers its words up to the next one's start
    covered = f"aggregate(twice, struct(0L as n, -{WINDOW} as last), (s, i) -> struct(s.n + least({WINDOW}, i - s.last) as n, i as last), s -> s.n)"
    return spans.withColumn("n_repeat_words", F.when(F.col("twice").isNotNull(), F.expr(covered)).otherwise(F.lit(0)).cast("long")).drop(
        "windows", "placed", "twice"
    )


def log_tail(rate: float) -> Column:
    """Natural log of P(X <= rejected) for X binomial with ``good`` trials of probability ``rate``, summed term by term.

    Above the mean it is no evidence of a low rate, and 0 is given.
    """
    p = f"{rate!r}D"
    term = f"a.t + ln((good - k + 1) / k) + ln({p} / (1 - {p}))"
    none = f"good * ln(1 - {p})"
    total = f"""aggregate(
        sequence(1, cast(rejected as int)), struct({none} as t, {none} as s),
        (a, k) -> struct({term} as t, greatest(a.s, {term}) + ln(1 + exp(-abs(a.s - ({term})))) as s), a -> a.s)"""
    return F.expr(f"case when rejected > good * {p} then 0 when rejected = 0 then {none} else {total} end").cast("double")


def cutoffs(measured: DataFrame, labels: DataFrame, stratum: str, risk: float, error: float) -> DataFrame:
    """One row per stratum: for each rule the lowest cutoff that passes its binomial test, or null."""
    good = labels.where("quality = 1").select(F.col("doc_id").alias("good_id")).distinct()
    rows = measured.join(good, F.col("doc_id") == F.col("good_id"), "left_semi")
    each = ", ".join(f"'{name}', {measure}" for name, measure in RULES.items())
    step = CUTOFFS[0]
    passed = f"cast(least({len(CUTOFFS)}, greatest(value - 1, 0) div {step}) as int)"
    bins = (
        rows.select(F.col(stratum).alias("stratum"), F.expr(f"stack({len(RULES)}, {each}) as (rule, value)"))
        .groupBy("stratum", "rule", F.expr(passed).alias("bin"))
        .agg(F.count("*").alias("n"))
    )
    # every candidate, also those that no document lies at
    grid = bins.select("stratum", "rule").distinct().withColumn("bin", F.explode(F.sequence(F.lit(0), F.lit(len(CUTOFFS)))))
    same = F.col("g.stratum").eqNullSafe(F.col("b.stratum")) & (F.col("g.rule") == F.col("b.rule")) & (F.col("g.bin") == F.col("b.bin"))
    filled = grid.alias("g").join(bins.alias("b"), same, "left").select("g.stratum", "g.rule", "g.bin", F.coalesce("b.n", F.lit(0)).alias("n"))
    down = Window.partitionBy("stratum", "rule").orderBy(F.desc("bin"))
    tested = filled.withColumn("rejected", F.sum("n").over(down)).withColumn("good", F.sum("n").over(Window.partitionBy("stratum", "rule")))
    tests = F.count_distinct("stratum") + F.max(F.col("stratum").isNull().cast("int"))
    level = bins.agg((F.lit(error) / (tests * len(RULES) * len(CUTOFFS))).alias("level"))
    usable = tested.where("bin > 0").crossJoin(F.broadcast(level)).where(log_tail(risk / len(RULES)) <= F.ln("level"))  # one row
    return usable.groupBy("stratum").agg(*[F.min(F.when(F.col("rule") == name, F.col("bin") * step)).alias(f"cut_{name}") for name in RULES])


def judge(docs: DataFrame, labels: DataFrame, stratum: str = "lang", risk: float = 0.02, error: float = 0.05) -> DataFrame:
    """Measures of every row of ``docs`` (doc_id, text, stratum) with ``base_failed`` and ``kept``.

    ``base_failed`` is the fixed rule: under 20 words, or over 30 % of words in
    repeated windows.  ``kept`` is false there, and where a measure exceeds the
    cutoff that ``labels`` (doc_id, quality) allow in its stratum.
    """
    measured = kept(measures(docs.select("doc_id", "text", F.col(stratum).alias("stratum")), "stratum"), "measures")
    cuts = cutoffs(measured, labels, "stratum", risk, error).withColumnRenamed("stratum", "cut_stratum")
    rows = measured.join(cuts, F.col("stratum").eqNullSafe(F.col("cut_stratum")), "left")
    fires = F.lit(False)
    for name, measure in RULES.items():
        fires = fires | F.coalesce(F.expr(f"{measure} > cut_{name}"), F.lit(False))
    failed = F.expr("n_words < 20 or 100 * n_repeat_words > 30 * n_words")
    return rows.withColumn("base_failed", failed).withColumn("kept", ~F.col("base_failed") & ~fires)
