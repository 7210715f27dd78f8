"""A training corpus from raw documents, in stages that each read what the one before has kept.

Each stage takes (spark, docs, sf_dir) and returns documents; `run` writes the result of each as Parquet in the shared
folder and reads it again, so a lost executor costs one stage at most.

Cases, for all stages: null and empty texts are clean, stay, and have no tokens; so do rows without id. Rows of one id are judged each by
its own text; of rows with one id and one text, near-dedup leaves one. Of texts that are equally good, that of the smallest id
stays, then the smaller hash. Texts of any length are worked on whole. An empty table stays empty. Further columns pass
through, whatever their names, but for `token_ids` and `decoded`, which the last stage adds.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from callgrain.llm import bpe, decontam, near_text, queries as q, secret_scan, toxicity
from callgrain.llm.shipping import ship
from callgrain.sources.sinks import stage


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the factorization machine, fitted on the labelled ones among them, does not reject."""
    ship(spark)
    return toxicity.without_toxic(docs, q.fitted_toxicity(spark, docs, sf_dir))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    ship(spark)
    return near_text.first_of_groups(docs)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no test item."""
    return decontam.without_leaks(docs, q.table(spark, sf_dir, "benchmark"))


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets that the forest keeps are replaced in the texts; n_chars of the changed texts follows."""
    rows = docs.select(
        F.struct(*[F.col(c) for c in docs.columns]).alias("doc"), secret_scan.redacted_text(F.col("text"), q.fitted_forest(docs)).alias("clean"))
    size = F.when(F.col("clean").eqNullSafe(F.col("doc.text")), F.col("doc.n_chars")).otherwise(
        F.length("clean").cast(docs.schema["n_chars"].dataType))
    changed = {"text": F.col("clean"), "n_chars": size}
    return rows.select(*[changed.get(c, F.col("doc")[c]).alias(c) for c in docs.columns])


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents with their token ids, and the text that these decode to."""
    ship(spark)
    return bpe.with_tokens(docs, q.vocabulary("word_bpe_49k.json"))


STAGES = [
    ("toxicity", drop_toxic),
    ("minhash near dedup", drop_near_copies),
    ("benchmark decontamination", drop_leaks),
    ("secret scan", redact_secrets),
    ("bpe", tokenize),
]

#: Fitted models and tokenizers have no SQL; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, step in STAGES:
        docs = stage(step(spark, docs, sf_dir), name.replace(" ", "_"))
    return docs
