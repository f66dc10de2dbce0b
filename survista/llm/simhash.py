"""SimHash near-duplicates by covering locality-sensitive hashing."""

from __future__ import annotations

from functools import partial
from itertools import product

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from survista.llm.common import materialise, utf8
from survista.llm.components import connected_components

#: Shingles whose bits are counted at a time.
_STEP = 1 << 16


def fingerprint(text: bytes, shingle: int = 3, seed: int = 42) -> int:
    """64-bit SimHash: a bit is 1 if it is set in over half the XXH64 of the word shingles, repeats counted."""
    words = text.lower().split()  # bytes: lower() takes A-Z, split() takes \\x20 and \\x09-\\x0D
    if not words:
        return 0
    joined = b" ".join(words)
    n = len(words) - shingle + 1
    if n <= 1:
        shingles = [joined]
    else:
        ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
        starts = np.concatenate(([0], ends[:-1] + 1))
        shingles = [joined[a:b] for a, b in zip(starts[:n].tolist(), ends[shingle - 1:].tolist(), strict=True)]
    ones = np.zeros(64, np.int64)
    digest = partial(xxhash.xxh64_intdigest, seed=seed)
    for i in range(0, len(shingles), _STEP):
        h = np.fromiter(map(digest, shingles[i:i + _STEP]), np.uint64)
        ones += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(ones * 2 > len(shingles), bitorder="little").view(np.int64)[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3) -> DataFrame:
    """(id, fp) for every row; fp is the SimHash as a signed long. Null text counts as empty."""
    spec = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))

    def hashed(batches):
        for b in batches:
            fp = np.fromiter((fingerprint(t, shingle) for t in utf8(b.column(1))), np.int64, b.num_rows)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(fp)], ["id", "fp"])

    return spec.mapInArrow(hashed, f"id {spec.schema['id'].dataType.simpleString()}, fp bigint")


def covering_masks(radius: int, bits: int = 64) -> list[int]:
    """2**(radius+1) - 1 masks such that any ``radius`` bit positions are all left out by some mask.

    Position i gets the nonzero vector m(i) of radius+1 bits, the mask of v holds the positions with an odd inner
    product m(i).v. Any ``radius`` vectors span less than the space, so some v is orthogonal to all of them.
    """
    whole = 1 << (radius + 1)
    vectors = [1 + i % (whole - 1) for i in range(bits)]
    return [sum(1 << i for i, m in enumerate(vectors) if (m & v).bit_count() % 2) for v in range(1, whole)]


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def links(fps: DataFrame, radius: int = 2, bucket: int = 64) -> DataFrame:
    """(u, v) links among distinct fingerprints ``fp`` whose connected components are those of all pairs at most
    ``radius`` bits apart.

    Each covering mask is a table keyed by the masked fingerprint; every pair within the radius shares a key in
    some table. Keys with up to ``bucket`` fingerprints compare their pairs. Fingerprints of fuller keys go
    another exact way: fingerprints within the radius share a point at ceil(radius/2) bits from one of them and
    floor(radius/2) from the other, so each emits the points of those balls, and all that meet in a point by the
    two balls link to one of them. A point has at most 65 neighbours at one bit, so nothing grows with the group.
    """
    tables = F.explode(F.array(*[F.struct(F.lit(k).alias("t"), F.col("fp").bitwiseAND(F.lit(_signed(m))).alias("key"))
                                 for k, m in enumerate(covering_masks(radius))])).alias("k")
    keyed = fps.select("fp", tables).select("k.t", "k.key", "fp")
    sizes = keyed.groupBy("t", "key").agg(F.count("*").alias("n")).filter("n > 1")
    sized = materialise(keyed.join(sizes, ["t", "key"]), "simhash-buckets")
    small = sized.filter(F.col("n") <= bucket)
    near = (small.alias("a").join(small.alias("b"), ["t", "key"]).filter("a.fp < b.fp")
            .filter(F.bit_count(F.col("a.fp").bitwiseXOR(F.col("b.fp"))) <= radius)
            .select(F.col("a.fp").alias("u"), F.col("b.fp").alias("v")))
    full = sized.filter(F.col("n") > bucket).select("fp").distinct()
    return near.union(_ball_links(full, radius)).distinct()


def _flips(fp, upto: int, bits: int = 64):
    """All values at most ``upto`` bits from ``fp``: an array column."""
    sets = {0}
    for _ in range(upto):
        sets |= {s ^ (1 << i) for s, i in product(sets, range(bits))}
    return F.transform(F.array(*[F.lit(_signed(s)) for s in sorted(sets)]), lambda s: fp.bitwiseXOR(s))


def _ball_links(fps: DataFrame, radius: int) -> DataFrame:
    """Links of fingerprints by shared ball points. For an even radius both balls are alike and all fingerprints at
    a point are pairwise within the radius: a star around the smallest. For an odd radius the point links the
    fingerprints of its smaller ball (pairwise within radius - 1) with each of its larger ball, which are compared
    to the smallest of the smaller ball, again no more than the radius apart."""
    inner, outer = radius // 2, radius - radius // 2
    near = fps.select("fp", F.explode(_flips(F.col("fp"), inner)).alias("z"))
    least = near.groupBy("z").agg(F.min("fp").alias("m"))
    far = near if outer == inner else fps.select("fp", F.explode(_flips(F.col("fp"), outer)).alias("z"))
    return far.join(least, "z").filter("fp != m").select(F.col("m").alias("u"), F.col("fp").alias("v"))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3,
                    radius: int = 2) -> DataFrame:
    """One row per row of ``docs``: id_col, fingerprint (16 hex digits), component_id.

    component_id is the smallest id reachable over links of at most ``radius`` differing bits, the row's own
    included. Null and empty texts have fingerprint zero and link like any other. Rows with a null id take part in
    linking; their component_id is the smallest id that is not null, and null where a component has none. Repeated
    rows give repeated result rows. An empty table gives none. Other columns are not read.
    """
    hashed = materialise(fingerprints(docs, id_col, text_col, shingle), "simhash")
    classes = materialise(hashed.groupBy("fp").agg(F.min("id").alias("least")), "simhash-classes")
    labels = connected_components(links(classes.select("fp"), radius))
    known = classes.join(labels, classes.fp == labels.node, "left").select(
        "fp", "least", F.coalesce("label", "fp").alias("label"))
    group = known.groupBy("label").agg(F.min("least").alias("component_id"))
    member = known.join(group, "label").select("fp", "component_id")
    return hashed.join(member, "fp", "left").select(
        F.col("id").alias(id_col), F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3,
             radius: int = 2) -> DataFrame:
    """One row of ``docs`` for each group of near duplicates: the one with the smallest id, a null id last, then with the
    smallest hash of its text. Rows alike in both differ by a number they are written with, so that one of them stays
    whether ids are null or repeated. All columns are kept."""
    key = F.struct(F.col(id_col).isNull().alias("none"), F.col(id_col).alias("id"), F.xxhash64(text_col).alias("hash"),
                   F.monotonically_increasing_id().alias("row"))
    numbered = materialise(docs.withColumn("__key", key), "simhash-rows")
    found = near_duplicates(numbered.select("__key", text_col), "__key", text_col, shingle, radius)
    stay = found.filter(F.col("__key") == F.col("component_id")).select(F.col("__key.row").alias("__row"))
    return numbered.join(stay, numbered["__key"]["row"] == stay["__row"], "left_semi").drop("__key")
