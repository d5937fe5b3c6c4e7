"""Corpus pipeline over ``documents``: language ID, exact dedup, near-dedup, mixing, packing.

``STAGES`` lists (name, function); each function takes (spark, docs, sf_dir) and
returns the next stage's documents (the last one returns the packed pieces).
``run`` writes every stage's result as Parquet in the shared folder and reads
it back, so a lost executor never costs more than one stage.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomweave.llm import chunk_dedup, lang_kn, pack_gga, pareto_mix, simhash_gph
from loomweave.llm.io import table
from loomweave.llm.queries import tokenizer_path
from loomweave.session import checkpoint_dir

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is recognised; what the model rejects goes."""
    return lang_kn.accepted(docs)


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts (A-Z lower-cased), the largest doc_id."""
    return chunk_dedup.keep_one(docs)


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of fingerprints linked at 3 bits or fewer, the smallest doc_id."""
    return simhash_gph.keep_one(docs, n=3, distance=3)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them: weights 3, 1, 2 over 150 % of the words."""
    return pareto_mix.mixed_documents(docs, weights=(3.0, 1.0, 2.0), total_share=1.5, most_copies=2)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of every document copy, packed into sequences of 2048 tokens."""
    return pack_gga.pack(docs, tokenizer_path("word_bpe_49k.json"))


STAGES = [("language_id", language_id), ("exact_dedup", exact_dedup), ("simhash_near_dedup", simhash_near_dedup),
          ("mix_sources", mix_sources), ("best_fit_packing", best_fit_packing)]

#: A trained model and a tokenizer library decide; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    base = f"{checkpoint_dir(spark).rstrip('/')}/corpus-{uuid.uuid4().hex}"
    docs = table(spark, sf_dir, "documents").select(*COLUMNS)
    for name, stage in STAGES:
        stage(spark, docs, sf_dir).write.parquet(f"{base}/{name}")
        docs = spark.read.parquet(f"{base}/{name}")
    return docs
