"""A training corpus out of documents, in five stages.

Each stage reads what the one before it wrote and keeps every document that its
operator has nothing against.  A row without id is a document of its text: such
rows with one text are decided alike.  All rows of an id share its decision.  Of
rows that agree in id and words only one is left by ``near_duplicates``, and of
rows without words all.  Null and empty texts have no toxic word, no copy, no
benchmark item and no secret, and are never taken by ``mix``.  Texts of any
length are read whole.  Ties go to the smallest id.  An empty table stays empty.
Extra columns pass through, whatever their names.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemart.llm import decontam, jaccard_join, mixing, secrets
from tidemart.llm.ids import of_ids
from tidemart.llm.queries import table, toxicity_scores
from tidemart.llm.scratch import kept

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


#: Id of a row without one, from its text; above all ids in use, so that a document with an id is kept before it.
OWN_ID = "coalesce(cast(doc_id as bigint), xxhash64('no id', text) & 4611686018427387903 | 4611686018427387904)"


def named(docs: DataFrame) -> DataFrame:
    """(doc_id, text) in which every row has an id."""
    return docs.select(F.expr(OWN_ID).alias("doc_id"), "text")


def without(docs: DataFrame, ids: DataFrame, how: str = "left_anti") -> DataFrame:
    """``docs`` but for the rows of the given ids, those made from texts included."""
    key = "own_id"
    while key in docs.columns:
        key += "_"
    return of_ids(docs.withColumn(key, F.expr(OWN_ID)), ids, how, key).drop(key)


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents whose toxicity score reaches the threshold, and with them all rows of their id."""
    scores = toxicity_scores(named(docs), table(spark, sf_dir, "labels"))
    return without(docs, kept(scores.where("predicted = 1").select("doc_id"), "toxic-ids"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of linked documents keep the one with the smallest id, and of its rows with equal text one."""
    found = kept(jaccard_join.near_duplicates(named(docs)), "near-duplicates")
    rest = without(docs, found.where("component_id <> doc_id").select("doc_id"))
    repeated = kept(found.where("n_shingles > 0").groupBy("doc_id").agg(F.count("*").alias("rows")).where("rows > 1").select("doc_id"), "repeated-ids")
    if repeated.isEmpty():
        return rest
    several = without(rest, repeated, "left_semi")
    one = several.groupBy("doc_id", "text").agg(F.min(F.struct(*docs.columns)).alias("row")).select("row.*")
    return without(rest, repeated).unionByName(one)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that hold an item of the benchmark."""
    found = decontam.leaks(named(docs), table(spark, sf_dir, "benchmark")).select("doc_id")
    return without(docs, kept(found, "leaks"))


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Mask the secrets in every text; no document is dropped."""
    return secrets.masked(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mixture of sources: each document as often as it is taken, with the number of its copy."""
    return mixing.mix(docs)


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", toxicity),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("secret_scan", secret_scan),
    ("mix", mix),
]

#: Learnt scores and near-duplicate groups are no SQL; the tests hold the stages against brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply all stages to ``documents``; each stage's result is written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        result = stage(spark, docs, sf_dir)
        docs = kept(result, f"stage-{name}")
    return docs
