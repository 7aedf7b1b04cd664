"""One query per operator over the given tables, and DuckDB statements where SQL can express the result."""

from __future__ import annotations

import tempfile
import zipfile
from collections.abc import Callable
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemart.llm import collocations, decontam, jaccard_join, merkle, mixing, ngram_lm, passages, personal, quality_model, quality_rules, secrets, statements, toxicity, url_rules

Query = Callable[[SparkSession, str], DataFrame]

#: The rules of op6 as (host, path, verdict).
URL_RULES = (
    ("org", "/", "allow"),
    ("example.org", "/es/", "block"),
    ("example.org", "/en/1", "block"),
    ("com", "/fr/", "allow"),
    ("com", "/de/", "block"),
)


def ship(spark: SparkSession) -> None:
    """Send the package to the executors once a session, as they may not have it installed."""
    context = spark.sparkContext
    if not getattr(context, "tidemart_shipped", False):
        root = Path(__file__).resolve().parents[2]
        archive = Path(tempfile.mkdtemp(prefix="tidemart-")) / "tidemart_package.zip"  # the driver serves it as long as the session lives
        with zipfile.ZipFile(archive, "w") as z:
            for file in sorted((root / "tidemart").rglob("*.py")):
                z.write(file, file.relative_to(root))
        context.addPyFile(str(archive))
        context.tidemart_shipped = True


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def remainder(column: str, of: int) -> Column:
    """crc32 of the id as text (null: empty), modulo ``of``."""
    return F.pmod(F.crc32(F.coalesce(F.col(column).cast("string"), F.lit(""))), F.lit(of))


def op1_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    mixed = mixing.repetitions(mixing.sizes(docs)).withColumn("row", F.explode(F.sequence(F.lit(1).cast("long"), F.col("rows"))))
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


def op2_ngram_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_lm.score(table(spark, sf_dir, "documents"))


def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


TOXIC_AT = 0.3


def toxicity_scores(docs: DataFrame, labels: DataFrame) -> DataFrame:
    found = toxicity.score(docs, labels.where(remainder("doc_id", 4) != 2))
    return found.select(
        "doc_id", (remainder("doc_id", 4) == 2).alias("held_out"), "score", (F.col("score") >= TOXIC_AT).cast("int").alias("predicted"), F.size("passages").alias("n_passages")
    )


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op5_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.digest(table(spark, sf_dir, "documents"))


def op6_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.createDataFrame(list(URL_RULES), "host string, path string, verdict string")
    return url_rules.judge(table(spark, sf_dir, "pages"), rules)


def op7_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.near_duplicates(table(spark, sf_dir, "documents"))


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = table(spark, sf_dir, "labels").where(remainder("doc_id", 3) != 1)
    found = quality_model.score(table(spark, sf_dir, "documents"), labels)
    return found.select("doc_id", (remainder("doc_id", 3) == 1).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op9_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return passages.repeated_passages(table(spark, sf_dir, "documents"))


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality_rules.judge(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op11_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = merkle.manifest(table(spark, sf_dir, "documents"), F.crc32(F.col("doc_id").cast("string")) % 7 == 0)
    return found.drop("path")


def op12_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return personal.digest(table(spark, sf_dir, "documents"))


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(table(spark, sf_dir, "documents"))


OPERATORS: dict[str, Query] = {
    q.__name__: q
    for q in (
        op1_mixing,
        op2_ngram_score,
        op3_decontamination,
        op4_toxicity,
        op5_secrets,
        op6_url_rules,
        op7_jaccard_join,
        op8_quality,
        op9_passages,
        op10_quality_rules,
        op11_merkle,
        op12_personal_data,
        op13_collocations,
    )
}

OP1_SQL = r"""
WITH d AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
         md5('mix-1:' || coalesce(doc_id::VARCHAR, '')) AS place
  FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source),
w AS (SELECT *, (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS weight FROM s),
r AS (SELECT *, 3 * source_size AS cap, (3 * source_size)::DOUBLE / weight AS ratio, (SELECT sum(source_size) FROM s)::DOUBLE AS total FROM w),
l AS (SELECT *, coalesce(sum(cap) OVER before, 0)::DOUBLE AS capped,
        ((SELECT sum(weight) FROM w) - coalesce(sum(weight) OVER before, 0))::DOUBLE AS open
      FROM r WINDOW before AS (ORDER BY ratio, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
f AS (SELECT total - capped AS rest, open FROM l WHERE ratio >= (total - capped) / open ORDER BY ratio, source NULLS LAST LIMIT 1),
t AS (SELECT source, source_size, coalesce(least(cap::DOUBLE, (SELECT rest * l.weight / open FROM f)), cap::DOUBLE) AS target FROM l),
u AS (SELECT doc_id, source, size, place, count(*) AS n FROM d GROUP BY ALL),
c AS (SELECT *, coalesce(sum(size * n) OVER (PARTITION BY source ORDER BY place, doc_id, size
                         ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::DOUBLE + size * n / 2.0::DOUBLE AS middle FROM u),
m AS (SELECT c.*, t.source_size, t.target, CASE WHEN t.source_size > 0 THEN floor(t.target / t.source_size) ELSE 0 END AS whole
      FROM c JOIN t ON c.source IS NOT DISTINCT FROM t.source),
x AS (SELECT doc_id, source, size, source_size, target,
        (size * CASE WHEN size > 0 THEN whole + CASE WHEN middle < target - whole * source_size THEN 1 ELSE 0 END ELSE 0 END)::BIGINT AS taken FROM m)
SELECT d.doc_id, d.size, x.source_size, x.target, x.taken
FROM d JOIN x ON d.doc_id IS NOT DISTINCT FROM x.doc_id AND d.source IS NOT DISTINCT FROM x.source AND d.size = x.size
"""

OP6_SQL = r"""
WITH rules(host, path, verdict) AS (VALUES
  ('org', '/', 'allow'), ('example.org', '/es/', 'block'), ('example.org', '/en/1', 'block'), ('com', '/fr/', 'allow'), ('com', '/de/', 'block')),
r AS (SELECT page_id, row_number() OVER () AS k, CASE WHEN contains(url, '://') THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages),
p AS (SELECT page_id, k, translate(regexp_extract(rest, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
        regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM r),
b AS (SELECT p.k, max({'size': length(rules.host || rules.path), 'host_size': length(rules.host), 'rule': rules.host || rules.path, 'verdict': rules.verdict}) AS won
      FROM p JOIN rules ON (p.host = rules.host OR ends_with(p.host, '.' || rules.host)) AND starts_with(p.path, rules.path) GROUP BY p.k)
SELECT p.page_id, p.host, p.path, b.won.rule AS rule, coalesce(b.won.verdict, 'allow') AS verdict FROM p LEFT JOIN b ON p.k = b.k
"""

ORACLE: dict[str, str] = {
    "op1_mixing": OP1_SQL,
    "op6_url_rules": OP6_SQL,
    "op11_merkle": statements.OP11_SQL,
    "op12_personal_data": statements.OP12_SQL,
    "op13_collocations": statements.OP13_SQL,
}
