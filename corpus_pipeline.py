"""A training corpus from raw documents: quality rules, line dedup, near duplicates, decontamination, packing.

Each stage gets what its predecessor kept, from Parquet. All but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelog.llm import quality
from tidelog.llm.common import table, written
from tidelog.llm.decontaminate import decontaminate
from tidelog.llm.linededup import LineDedup
from tidelog.llm.ngram_join import one_of_each
from tidelog.llm.queries import packed

#: The last stage's tokenizer is beyond SQL; tests compare run() with a plain version of all stages.
ORACLE_SQL = None


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that no rule rejects: those of the base (too short, repetitive) and the further ones with the learned toxic words."""
    rules = quality.order_rules(docs, quality.base_rules() + quality.default_rules(*quality.learned(docs, table(spark, sf_dir, "labels"))))
    return quality.cascade(docs, rules, kept="__kept").where("__kept").select(docs.columns)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the lines that ten or more of them hold; n_chars follows the text."""
    cleaned = LineDedup(spark, min_docs=10, min_chars=1).insert(docs).clean(docs)
    return cleaned.withColumn("text", F.col("kept_text")).withColumn("n_chars", F.char_length("text").cast("long")).select(docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that links of 0.8 or more hold together: the one with the least id."""
    return one_of_each(docs).select(docs.columns)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which less than a twentieth of the words is inside benchmark windows."""
    found = decontaminate(docs, table(spark, sf_dir, "benchmark"))
    return found.where("not (n_hit > 0 and n_hit * 20 >= n_words)").select(docs.columns)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents' pieces in sequences of 4096 tokens."""
    return packed(docs.select("doc_id", "text"))


STAGES = [("quality_rules", quality_rules), ("line_dedup", line_dedup), ("near_duplicates", near_duplicates),
          ("decontamination", decontamination), ("packing", packing)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir))
    return docs
