"""The corpus pipeline: documents to packed training sequences.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame, which is
written as Parquet and reread as the next stage's ``docs``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from claimflow.llm.exact import stage_exact_dedup
from claimflow.llm.minhash import stage_near_dedup
from claimflow.llm.mixing import stage_mix
from claimflow.llm.packing import stage_pack
from claimflow.llm.quality import stage_quality
from claimflow.llm.scratch import scratch

STAGES = [
    ("quality classifier", stage_quality),
    ("exact dedup", stage_exact_dedup),
    ("MinHash near-dedup", stage_near_dedup),
    ("mixing sources to target weights", stage_mix),
    ("packing", stage_pack),
]

# A trained classifier, signatures and token ids have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole ``documents`` table."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    with scratch(spark) as work:
        for name, stage in STAGES[:-1]:
            docs = work.stage(stage(spark, docs, sf_dir), name.replace(" ", "-"))
        return work.result(STAGES[-1][1](spark, docs, sf_dir), "pipeline")
