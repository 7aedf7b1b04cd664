"""Judge urls by nested host and path rules with a sort-merge range join.

The canonical key of a host and path is the host's labels in reverse order, a
separator, and the path, so that all paths below a rule form one interval of
keys.  A url asks once for its host and once for each parent domain.  Questions
and rules are sorted together; a sweep carries the stack of rules whose
intervals are open (each rule brings the rules it is nested in), and a question
takes the innermost of the stack that still holds it.  Of a url's answers the
longest rule wins, then the one with the longer host.

The sweep runs over ranges of (key, salt).  The salt breaks ties, so a key with
many rows is split like any other; a range starts with the rules open at its
first key, which are the prefixes of that key.  Cut points come from a sample of
bounded size, and affect balance only, never results.

Null urls and urls without ``://`` have an empty host and path and fit no rule.
Repeated rows are judged once and returned as often as they came.  A rule that
is listed twice with two verdicts blocks.  Extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemart.llm.scratch import kept, width

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Sorts below every character of a host label.
MARK = "\x01"
#: Sampled keys for each range.
SAMPLED = 16


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host and path of a url; both empty without ``://``."""
    at = F.locate("://", url)
    rest = F.substring(url, at + 3, F.length(url))
    found = at > 0
    host = F.translate(F.regexp_extract(rest, r"^([^/?#]*)", 1), UPPER, LOWER)
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    return F.when(found, host).otherwise(""), F.when(found, path).otherwise("")


def _key(labels: Column, path: Column) -> Column:
    return F.concat(F.array_join(labels, "."), F.lit(MARK), path)


def _nested(points: DataFrame, rules: DataFrame, *by: str) -> DataFrame:
    """For each key among ``points``, the rules that are prefixes of it, outermost first."""
    heads = points.select(*by, F.explode(F.expr("transform(sequence(1, length(key)), n -> substring(key, 1, n))")).alias("head"))
    return (
        heads.join(rules.withColumnRenamed("key", "head"), "head")
        .groupBy(*by)
        .agg(F.array_sort(F.collect_list(F.struct(F.length("head").alias("size"), F.col("head").alias("key"), "rule", "verdict"))).alias("stack"))
    )


def _cuts(points: DataFrame, ranges: int) -> list[tuple[str, int]]:
    """At most ``ranges - 1`` (key, salt) pairs that split the points about evenly."""
    sample = [tuple(r) for r in points.orderBy(F.xxhash64("key", "salt"), "key", "salt").limit(ranges * SAMPLED).select("key", "salt").collect()]
    sample = sorted(set(sample), key=lambda x: (x[0].encode(), x[1]))
    step = max(1, len(sample) // ranges)
    return sample[step::step][: ranges - 1]


def _range_of(cuts: list[tuple[str, int]]) -> Column:
    """Number of cut points at or below (key, salt), found in two steps of about the square root of their number."""
    if not cuts:
        return F.lit(0)
    block = max(1, int(len(cuts) ** 0.5))
    blocks = [cuts[k : k + block] for k in range(0, len(cuts), block)]
    me = F.struct(F.col("key"), F.col("salt").cast("long"))

    def at(pairs: list[tuple[str, int]]) -> Column:
        return F.array(*[F.struct(F.lit(k).alias("key"), F.lit(s).cast("long").alias("salt")) for k, s in pairs])

    coarse = F.size(F.filter(at([b[0] for b in blocks]), lambda x: x <= me))
    inner = F.element_at(F.array(*[at(b) for b in blocks]), F.greatest(coarse, F.lit(1)))
    return F.when(coarse == 0, 0).otherwise((coarse - 1) * block + F.size(F.filter(inner, lambda x: x <= me)))


def judge(pages: DataFrame, rules: DataFrame, default: str = "allow") -> DataFrame:
    """(page_id, host, path, rule, verdict) of each row of ``pages`` (page_id, url).

    ``rules`` has (host, path, verdict) with verdict allow or block; a url that
    no rule fits gets ``default``.
    """
    spark = pages.sparkSession
    host, path = host_and_path(F.col("url"))
    urls = pages.select("page_id", host.alias("host"), path.alias("path")).groupBy("page_id", "host", "path").agg(F.count("*").alias("rows"))
    urls = kept(urls, "urls")
    ruled = rules.select(
        _key(F.reverse(F.split(F.translate("host", UPPER, LOWER), r"\.")), F.col("path")).alias("key"),
        F.concat(F.translate("host", UPPER, LOWER), F.col("path")).alias("rule"),
        "verdict",
    )
    ruled = kept(ruled.where("key is not null").groupBy("key").agg(F.min("rule").alias("rule"), F.max("verdict").alias("verdict")), "rules")

    labels = F.reverse(F.split("host", r"\."))
    depth = F.explode(F.sequence(F.lit(1), F.size("labels")))
    asked = urls.where("host <> ''").withColumn("labels", labels).withColumn("depth", depth)
    points = asked.select("page_id", "host", "path", _key(F.slice("labels", F.lit(1), F.col("depth")), F.col("path")).alias("key"))
    points = points.withColumn("salt", F.xxhash64("page_id").bitwiseAND(0x7FFFFFFF))
    cuts = _cuts(points, width(spark))

    opened = ruled.join(_nested(ruled, ruled, "key"), "key").select("key", F.lit(-1).cast("long").alias("salt"), "stack")
    starts = [("", -2, 0)] + [(k, s, i + 1) for i, (k, s) in enumerate(cuts)]
    begins = spark.createDataFrame(starts, "key string, start_salt long, range int")
    begins = begins.join(_nested(begins.where("key <> ''"), ruled, "range"), "range", "left")
    begins = begins.select(F.lit("").alias("key"), F.lit(-2).cast("long").alias("salt"), "stack", "range")
    place = _range_of(cuts).cast("int")
    none = opened.schema["stack"].dataType
    events = (
        points.select("key", "salt", F.lit(None).cast(none).alias("stack"), place.alias("range"), "page_id", "host", "path")
        .unionByName(opened.withColumn("range", place), allowMissingColumns=True)
        .unionByName(begins, allowMissingColumns=True)
    )
    sweep = Window.partitionBy("range").orderBy("key", "salt").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    swept = events.withColumn("open", F.last("stack", ignorenulls=True).over(sweep)).where("host is not null")
    held = F.filter("open", lambda r: F.startswith(F.col("key"), r["key"]))
    answers = swept.withColumn("held", held).where(F.size("held") > 0).select("page_id", "host", "path", F.element_at("held", -1).alias("best"))
    rank = F.struct(F.length("best.rule").alias("size"), F.length(F.substring_index("best.rule", "/", 1)).alias("host_size"), "best.rule", "best.verdict")
    won = answers.groupBy("page_id", "host", "path").agg(F.max(rank).alias("won")).toDF("w_id", "w_host", "w_path", "won")
    same = F.col("page_id").eqNullSafe(F.col("w_id")) & (F.col("host") == F.col("w_host")) & (F.col("path") == F.col("w_path"))
    judged = urls.join(won, same, "left").withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("rows"))))
    return judged.select("page_id", "host", "path", F.col("won.rule").alias("rule"), F.coalesce(F.col("won.verdict"), F.lit(default)).alias("verdict"))
