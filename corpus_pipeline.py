"""The corpus pipeline: language, quality, near duplicates, mixing, packing.

``STAGES`` lists (name, function). Each function takes (spark, docs, sf_dir) and works on all rows of
``docs``, which the stage before kept; all but the last return rows with the columns of ``documents``. Null and empty texts go at
the first stage; repeated rows are one document from the third stage on, until the mix repeats a source on purpose; an empty
table passes through as an empty table.
"""

from __future__ import annotations

from salesmart.llm import langid, mixing, near_dup, packing, quality
from salesmart.llm.queries import tokenizer_json
from salesmart.storage import Scratch


def language(spark, docs, sf_dir):
    """Documents whose language is known."""
    return langid.kept_documents(docs, Scratch(spark, "pipeline-language"))


def good(spark, docs, sf_dir):
    """Documents that pass the base rules and are good by the rules' votes."""
    return quality.kept_documents(docs, Scratch(spark, "pipeline-quality"))


def distinct(spark, docs, sf_dir):
    """One document of every near-duplicate class."""
    return near_dup.kept_documents(docs, Scratch(spark, "pipeline-near"))


def mixed(spark, docs, sf_dir):
    """Every source as often as its target asks for."""
    return mixing.mixed_documents(docs, Scratch(spark, "pipeline-mix"))


def packed(spark, docs, sf_dir):
    """Pieces of documents in sequences of 2,048 tokens."""
    return packing.pack(docs, tokenizer_json(), Scratch(spark, "pipeline-pack"))


STAGES = [("language", language), ("quality", good), ("near_dedup", distinct), ("mixing", mixed), ("packing", packed)]

#: Byte models, weighted sampling and a tokenizer are beyond SQL; tests/llm holds the stages against brute force.
ORACLE_SQL = None


def run(spark, sf_dir):
    """Apply the stages to ``documents``; each reads what the one before wrote."""
    scratch = Scratch(spark, "pipeline")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = scratch.table(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
