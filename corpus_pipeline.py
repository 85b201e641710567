"""From raw documents to packed training sequences, stage by stage.

Each stage gets what the one before has kept, written and read again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from marlstone.llm import mixing, naming, near, packing, quality
from marlstone.llm._common import release, released, scratch, stored

#: Words of a shingle; near duplicates share four fifths or more of theirs.
NEAR_SHINGLE = 5


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rules or the line labels reject go."""
    crf = quality.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return quality.quality_rules(docs, crf, only_kept=True)


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts stays."""
    return naming.drop_exact_duplicates(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of texts alike at 0.8 or more stays."""
    return near.drop_near_texts(docs, shingle=NEAR_SHINGLE)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as its source's target asks for."""
    return mixing.mix(docs)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Which words of which document lie in which bin."""
    return packing.pack(docs)


STAGES = [
    ("quality_rules", quality_rules),
    ("exact_dedup", exact_dedup),
    ("near_dedup", near_dedup),
    ("source_mix", source_mix),
    ("best_fit_packing", best_fit_packing),
]

#: SQL can express neither Viterbi decoding nor fingerprints' components; tests/llm holds brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The packed corpus. Each stage's working tables go when its result is written, and that when the next one's is."""
    docs, before = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    for name, stage in STAGES[:-1]:
        path = scratch(spark, name)
        with released(spark):
            docs = stored(stage(spark, docs, sf_dir), name, path)
        if before:
            release(spark, before)
        before = path
    return STAGES[-1][1](spark, docs, sf_dir)
