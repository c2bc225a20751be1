"""The corpus pipeline: quality, near-duplicates, benchmark leaks, source mix, shards.

Each stage takes (spark, docs, sf_dir), works on all documents its predecessor kept, and returns the columns of documents; the
last one returns the shard of each document that is left. Between stages the rows are written and read back, so a lost
executor costs no more than the stage it works on.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from shelfwise.llm import bagminhash, cotraining, decontaminate, mixing, sharding
from shelfwise.llm.queries import MIX_BUDGET, MIX_LEVELS, MIX_SEED, MIX_WEIGHTS, table, with_domain
from shelfwise.session import cut_lineage


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents the co-trained classifier rejects for their quality or as toxic go."""
    return cotraining.keep_good(docs, table(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near copies stays."""
    return bagminhash.keep_one(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark window go."""
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The token budget is filled to the target weights, in one pass over each source."""
    taken = mixing.mix(with_domain(docs), MIX_LEVELS, MIX_WEIGHTS, MIX_BUDGET, 1, MIX_SEED)
    return taken.select(*docs.columns)


def shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard and hops of each document."""
    return sharding.shard_documents(docs)


STAGES = [
    ("quality", quality),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("source_mix", source_mix),
    ("shards", shards),
]

ORACLE_SQL = None  # the classifier and the signatures have no SQL form


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = cut_lineage(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
