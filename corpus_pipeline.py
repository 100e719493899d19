"""From raw documents to packed training sequences: stages that each apply one operator.

``run`` has no SQL twin: language scores and packing have none, so tests compare each stage with a brute-force version.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession

from dimflow.llm.language import keep_identified
from dimflow.llm.ngram_join import one_of_each_group
from dimflow.llm.packing import packed
from dimflow.llm.secrets import without_secrets
from dimflow.llm.suffix_dedup import without_repeats
from dimflow.session import bound_batches, cut_lineage


def in_small_batches(stage: Callable[..., DataFrame]) -> Callable[..., DataFrame]:
    """Stages follow each other on the same executors, whose memory has to hold all that each of them leaves."""

    @wraps(stage)
    def bounded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        bound_batches(spark)
        return stage(spark, docs, sf_dir)

    return bounded


STAGES = [
    ("language ID", in_small_batches(keep_identified)),
    ("n-gram Jaccard join", in_small_batches(one_of_each_group)),
    ("suffix-array dedup", in_small_batches(without_repeats)),
    ("secret scans", in_small_batches(without_secrets)),
    ("best-fit packing", in_small_batches(packed)),
]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows; each stage reads what the one before wrote."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = cut_lineage(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
