"""From raw documents to packed training sequences: five corpus operators, each over all that the one before kept.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame; it is written as Parquet and read again as the
next one's ``docs``. All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from sparkloom.llm.common import documents, ready, stage
from sparkloom.llm.importance import quality_stage
from sparkloom.llm.mixing import mix_stage
from sparkloom.llm.near_dedup import dedup_stage
from sparkloom.llm.packing import pack
from sparkloom.llm.secrets import redact_stage


def pack_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row per piece of a training sequence."""
    ready(spark)
    return pack(docs)


STAGES = [
    ("quality classifier", quality_stage),  # rejected documents go
    ("MinHash near-dedup", dedup_stage),  # one document of each group stays
    ("secret scans", redact_stage),  # secrets are blanked out, every document stays
    ("mixing sources to target weights", mix_stage),  # documents repeat or go so that sources meet their targets
    ("packing", pack_stage),
]

#: Generative models, signatures and tokenizers are beyond SQL; the tests hold each stage against a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for name, step in STAGES[:-1]:
        docs = stage(step(spark, docs, sf_dir), name.split()[0].lower())
    return STAGES[-1][1](spark, docs, sf_dir)
