"""A corpus pipeline over ``documents``: toxicity, line dedup, n-gram Jaccard
join, benchmark decontamination and mixing to target weights.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written
as Parquet and read again as the next stage's docs.  All but the last return
the columns of ``documents``; the last adds the rows' places in the mix.

* toxicity: documents predicted toxic go; the model learns from the labels of
  the documents given.
* line_dedup: lines that an earlier document holds go from the text, and
  n_chars follows; a document that loses all its lines stays, with the text it
  has left.
* ngram_jaccard_join: of each component of near duplicates the document with
  the smallest doc_id stays; documents without words stay.
* benchmark_decontamination: documents that hold a benchmark window go.
* mix_sources: every document gets its place.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm import decontam, line_dedup, mixing, ngram_join, toxicity
from tessera.llm.common import staged, table
from tessera.llm.registry import MIX_WEIGHTS


def reject_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return toxicity.reject(docs, table(spark, sf_dir, "labels"))


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    out = line_dedup.dedup_lines(docs).drop("n_lines", "n_dropped")
    if "n_chars" in docs.columns:
        length = F.char_length("text").cast(docs.schema["n_chars"].dataType)
        out = out.withColumn("n_chars", F.coalesce(length, F.col("n_chars")))
    return out.select(*docs.columns)


def keep_one_of_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return ngram_join.keep_one(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontam.remove(docs, table(spark, sf_dir, "benchmark"), how="documents")


def mix_to_weights(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mix(docs, MIX_WEIGHTS)


STAGES = [
    ("toxicity", reject_toxic),
    ("line_dedup", drop_repeated_lines),
    ("ngram_jaccard_join", keep_one_of_near_duplicates),
    ("benchmark_decontamination", drop_contaminated),
    ("mix_sources", mix_to_weights),
]

#: the first stage is a learned model and the last an online schedule, which
#: SQL cannot express; tests/llm compares each stage with a brute-force version
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
