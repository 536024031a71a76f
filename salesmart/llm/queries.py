"""Registered queries of the operators, and DuckDB SQL where SQL can express them."""

from __future__ import annotations

from pyspark.sql import functions as F

from salesmart.llm import alignment, chat, ctw, fingerprints, langid, main_text, mixing, near_dup, packing, quality, sharding, url_filter, vector_codes
from salesmart.storage import Scratch


def _table(spark, sf_dir, name):
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_mixing(spark, sf_dir):
    return mixing.mix(_table(spark, sf_dir, "documents"), Scratch(spark, "op1"))


def tokenizer_json(name="word_bpe_49k.json"):
    """A public tokenizer's file, read on the driver; tasks get its text."""
    import public_tokenizers

    with open(public_tokenizers.path(name), encoding="utf-8") as file:
        return file.read()


def op2_near_duplicates(spark, sf_dir):
    return near_dup.near_duplicates(_table(spark, sf_dir, "documents"), Scratch(spark, "op2"))


def op3_fingerprints(spark, sf_dir):
    return fingerprints.edited_fingerprints(_table(spark, sf_dir, "documents"))


def op4_url_filter(spark, sf_dir):
    return url_filter.judge(_table(spark, sf_dir, "pages"), Scratch(spark, "op4"))


def op5_context_tree(spark, sf_dir):
    training = ~ctw.held_out(F.col("doc_id"))
    return ctw.scored(_table(spark, sf_dir, "documents"), Scratch(spark, "op5"), training)


def op6_packing(spark, sf_dir):
    return packing.pack(_table(spark, sf_dir, "documents"), tokenizer_json(), Scratch(spark, "op6"))


def op7_chat(spark, sf_dir):
    turns = chat.canonical_turns(_table(spark, sf_dir, "conversations"))
    return chat.read_back(chat.format_turns(turns.unionByName(chat.control_conversation(spark))))


def op8_language(spark, sf_dir):
    return langid.identify(_table(spark, sf_dir, "documents"))


def op9_quality(spark, sf_dir):
    return quality.assess(_table(spark, sf_dir, "documents"), Scratch(spark, "op9"))


def op10_sharding(spark, sf_dir):
    return sharding.place(_table(spark, sf_dir, "documents"), Scratch(spark, "op10"))


def op11_vector_codes(spark, sf_dir):
    return vector_codes.encode(_table(spark, sf_dir, "embeddings"), Scratch(spark, "op11"))


def piece_model(name="piece_bpe_32k.model"):
    """A public piece tokenizer's file, read on the driver; tasks get its bytes."""
    import public_tokenizers

    with open(public_tokenizers.path(name), "rb") as file:
        return file.read()


def op12_alignment(spark, sf_dir):
    return alignment.align(_table(spark, sf_dir, "documents"), tokenizer_json("byte_bpe_50k.json"), piece_model(), Scratch(spark, "op12"))


def op13_main_text(spark, sf_dir):
    return main_text.extract(_table(spark, sf_dir, "pages"))


QUERIES = {query.__name__: query for query in (op1_mixing, op2_near_duplicates, op3_fingerprints, op4_url_filter, op5_context_tree, op6_packing, op7_chat, op8_language, op9_quality, op10_sharding, op11_vector_codes, op12_alignment, op13_main_text)}

SQL = {"op1_mixing": mixing.SQL, "op11_vector_codes": vector_codes.SQL}
