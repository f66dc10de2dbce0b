"""The registered queries of this package and their DuckDB SQL."""

from __future__ import annotations

import public_tokenizers

from pyspark.sql import functions as F

from survista.llm import (chat, decontaminate, exact, idfile, licences, lines, lm, negatives, packing, quality, shuffle, simhash,
                          spelling)
from survista.llm.common import read

QUERIES: dict = {}
ORACLE: dict[str, str] = {}


def query(f):
    QUERIES[f.__name__] = f
    return f


@query
def op2_simhash(spark, sf_dir):
    return simhash.near_duplicates(read(spark, sf_dir, "documents"), shingle=3, radius=2)


@query
def op6_exact_dedup(spark, sf_dir):
    return exact.exact_duplicates(read(spark, sf_dir, "documents"))


ORACLE["op6_exact_dedup"] = """
SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
       doc_id IS NOT DISTINCT FROM max(doc_id) OVER w AS kept, sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW w AS (PARTITION BY coalesce(text, ''))
"""


@query
def op7_id_files(spark, sf_dir):
    return idfile.round_trip(read(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), end_id=1)


@query
def op10_packing(spark, sf_dir):
    return packing.pack(read(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), end_id=2, size=1024)


@query
def op4_quality(spark, sf_dir):
    return quality.classify(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


@query
def op5_line_dedup(spark, sf_dir):
    docs = lines.drop_boilerplate(read(spark, sf_dir, "documents"), "source", ratio=0.01, min_pages=5, counts=("n_lines", "n_dropped"))
    return docs.select("doc_id", "source", "text", "n_lines", "n_dropped")


ORACLE["op5_line_dedup"] = lines.SQL.format(ratio=0.01, min_pages=5)


@query
def op9_licence_scan(spark, sf_dir):
    return licences.scan(read(spark, sf_dir, "documents")).drop("spans")


@query
def op1_lm_score(spark, sf_dir):
    docs = read(spark, sf_dir, "documents")
    fold = F.coalesce(F.crc32(F.col("doc_id").cast("string")), F.lit(0)) % 7
    out = lm.score(docs, fold != 2)
    return out.select("doc_id", (fold == 2).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")


def preference_turns(conversations):
    """Stand-in input: turns of chosen conversations, and of rejected ones that leave them after one to three turns and go on
    as the conversation with the next number does."""
    turns = conversations.select(F.col("conv_id").alias("pair_id"), "turn", "role", "text")
    ids = conversations.select(F.col("conv_id").alias("pair_id")).distinct()
    same = turns.filter("turn <= pair_id % 3")
    other = turns.withColumn("pair_id", F.col("pair_id") - 1).filter("turn > pair_id % 3").join(ids, "pair_id", "left_semi")
    return turns, same.union(other)


@query
def op3_preference_pairs(spark, sf_dir):
    chosen, rejected = preference_turns(read(spark, sf_dir, "conversations"))
    return chat.preference_pairs(chosen, rejected, public_tokenizers.path("byte_bpe_50k.json"))


@query
def op8_decontaminate(spark, sf_dir):
    items = decontaminate.question_and_answer(read(spark, sf_dir, "benchmark"))
    return decontaminate.contaminated(read(spark, sf_dir, "documents"), items)


@query
def op11_shards(spark, sf_dir):
    dealt = shuffle.shuffle_into_shards(read(spark, sf_dir, "documents"), shards=16)
    text = F.coalesce("text", F.lit(""))
    return dealt.select("doc_id", (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"),
                        F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


@query
def op12_hard_negatives(spark, sf_dir):
    """Every seventh row's label is moved on by one, so that the table has wrong ones."""
    table = read(spark, sf_dir, "embeddings")
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return negatives.hard_negatives(table.withColumn("label", label), F.col("vec_id") % 100 == 0)


@query
def op13_spelling(spark, sf_dir):
    return spelling.spelling_forms(read(spark, sf_dir, "documents"))
