"""Preference pairs as one prompt and two masked completions."""

from __future__ import annotations

from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from survista.llm.common import utf8
from survista.llm.tokens import encoder

def _slots(turns: DataFrame, pair_col: str, side: str) -> DataFrame:
    """One row for each pair and turn number; turns of equal number in the order of role and text."""
    said = F.struct(F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    return turns.groupBy(F.col(pair_col).alias("pair_id"), "turn").agg(F.sort_array(F.collect_list(said)).alias(side))


def _encoded(rows: DataFrame, tokenizer: str) -> DataFrame:
    """Adds ids and mask of each row's rendered turn: the mask is 1 on what the assistant says and the end of it."""
    def encode(batches):
        enc = encoder(tokenizer, True).encode
        for b in batches:
            ids, masks = [], []
            for head, body, learn in zip(utf8(b.column("head")), utf8(b.column("body")), b.column("learn").to_pylist(), strict=True):
                a, z = np.frombuffer(enc(head), "<u4"), np.frombuffer(enc(body), "<u4")
                ids.append(np.concatenate([a, z]).astype(np.int32))
                masks.append([*repeat(0, len(a)), *repeat(int(bool(learn)), len(z))])
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(ids, pa.list_(pa.int32())), pa.array(masks, pa.list_(pa.int32()))], [*b.schema.names, "ids", "mask"])

    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema)
    return rows.mapInArrow(encode, f"{kinds}, ids array<int>, mask array<int>")


def preference_pairs(chosen: DataFrame, rejected: DataFrame, tokenizer: str, pair_col: str = "pair_id",
                     block_turns: int | None = None) -> DataFrame:
    """Prompt and completions of each pair. ``chosen`` and ``rejected``: pair_col, turn, role, text, a row for each turn.

    Turns are aligned by number. The prompt is the longest common prefix: the turns before the first number at which role
    or text differ, or that one side lacks. It is rendered once; the rest of each side is its completion. A turn is
    rendered as "<|role|>\\n", its text and "\\n", each encoded on its own. Masks are 1 on the text and line end of
    assistant turns in a completion, 0 elsewhere. One row per pair: pair_col, block, prompt, prompt_ids, chosen, chosen_ids,
    chosen_mask, rejected, rejected_ids, rejected_mask; parts without turns are empty. A row is as large as its pair. Where
    a conversation may outgrow a task, ``block_turns`` asks for its parts instead: a row per pair and block of so many turn
    numbers, to be read in the order of ``block``, which is 0 otherwise.

    Pair ids may be of any type that casts to a string and back. Null roles and texts count as empty; a null turn number comes before all others; turns of equal number are ordered by
    role and text; null pair ids form one pair. Equal sides give two empty completions; a pair that one side lacks has an empty
    prompt. Empty tables give no rows; other columns are not read.
    """
    a, b = _slots(chosen, pair_col, "chosen"), _slots(rejected, pair_col, "rejected")
    # Nulls join by keys that are never null.
    kind = a.schema["pair_id"].dataType
    keys = [F.col("pair_id").isNull().alias("no_pair"), F.coalesce(F.col("pair_id").cast("string"), F.lit("")).alias("pair"),
            F.col("turn").isNull().alias("no_turn"), F.coalesce("turn", F.lit(0)).alias("number")]
    names = ["no_pair", "pair", "no_turn", "number"]
    both = a.select(*keys, "chosen").join(b.select(*keys, "rejected"), names, "full")
    order = F.when(F.col("no_turn"), F.lit(None)).otherwise(F.col("number").cast("bigint"))
    both = both.withColumn("at", F.coalesce(order, F.lit(-(1 << 62))))
    differ = ~F.col("chosen").eqNullSafe(F.col("rejected"))
    first = both.groupBy("no_pair", "pair").agg(F.min(F.when(differ, F.col("at"))).alias("first"))
    split = both.join(first, ["no_pair", "pair"]).withColumn("common", F.col("first").isNull() | (F.col("at") < F.col("first")))
    sides = F.when(F.col("common"), F.array(F.struct(F.lit("prompt").alias("part"), F.col("chosen").alias("said")))).otherwise(
        F.array(F.struct(F.lit("chosen").alias("part"), F.col("chosen").alias("said")), F.struct(F.lit("rejected").alias("part"), F.col("rejected").alias("said"))))
    turns = (split.select("no_pair", "pair", "at", F.explode(sides).alias("side"))
             .select("no_pair", "pair", "at", "side.part", F.posexplode("side.said").alias("tie", "say"))
             .select("no_pair", "pair", "at", "part", "tie", F.concat(F.lit("<|"), "say.role", F.lit("|>\n")).alias("head"),
                     F.concat("say.text", F.lit("\n")).alias("body"), ((F.col("part") != "prompt") & (F.col("say.role") == "assistant")).alias("learn")))
    block = F.lit(0) if block_turns is None else F.when(F.col("at") < 0, 0).otherwise(F.floor(F.col("at") / block_turns))
    done = _encoded(turns, tokenizer).withColumn("block", block)

    def part(name):
        turn = F.struct("at", "tie", F.concat("head", "body").alias("text"), "ids", "mask")
        return F.sort_array(F.collect_list(F.when(F.col("part") == name, turn)))

    parts = ("prompt", "chosen", "rejected")
    grouped = done.groupBy("no_pair", "pair", "block").agg(*[part(p).alias(p) for p in parts])
    out = [F.when(~F.col("no_pair"), F.col("pair")).cast(kind).alias(pair_col), F.col("block").cast("bigint").alias("block")]
    for p in parts:
        out += [F.array_join(F.col(f"{p}.text"), "").alias(p), F.flatten(F.col(f"{p}.ids")).alias(f"{p}_ids")]
        if p != "prompt":
            out.append(F.flatten(F.col(f"{p}.mask")).alias(f"{p}_mask"))
    return grouped.select(*out)
