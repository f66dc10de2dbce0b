"""Spelling variants: words one edit apart, found by Bloom-guided neighbourhoods.

The vocabulary's words go into blocked Bloom filters, sharded by word length, which are broadcast. Every word generates
its edits as hashes and probes them; only edits that a filter takes for words are written out as strings and shuffled
to the vocabulary, whose exact join removes the false positives. A pair is generated from one of its words alone: the
longer one deletes, of two equally long ones that with the smaller letter replaces it.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from survista.llm.common import materialise

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: Base of the polynomial hash (odd, so that it has an inverse modulo 2**64).
_BASE = 0x9E3779B97F4A7C15
_INVERSE = np.uint64(pow(_BASE, -1, 1 << 64))
#: A block is 8 words of 32 bits, a key sets one bit in each.
_LANES = 8
_SALTS = [pow(_BASE, i + 1, 1 << 32) for i in range(_LANES)]


def word_counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", drop: int = 97, min_length: int = 5) -> DataFrame:
    """(word, n): runs of Latin letters, A-Z lower-cased. A run whose crc32 of ``<id>:<run>`` is divisible by ``drop`` loses
    the code point that the crc32 names; words shorter than ``min_length`` do not count. A null text has no runs, a null
    id is the empty string."""
    text = F.translate(F.col(text_col).cast("string"), _UPPER, _UPPER.lower())
    runs = F.filter(F.regexp_extract_all(text, F.lit("[a-zÀ-ÿ]+"), F.lit(0)), lambda r: F.length(r) >= min_length)
    found = docs.select(F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("id"), F.explode(runs).alias("run"))
    h = F.crc32(F.concat("id", F.lit(":"), "run"))
    cut = (h % F.length("run")).cast("int")
    word = F.when(h % drop == 0, F.concat(F.substring("run", F.lit(1), cut), F.substring("run", cut + 2, F.length("run"))))
    return (found.select(F.coalesce(word, F.col("run")).alias("word")).filter(F.length("word") >= min_length)
            .groupBy("word").agg(F.count("*").alias("n")))


def mixed(h: np.ndarray) -> np.ndarray:
    """Spreads the bits of the polynomial hash."""
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(29))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(32))


def powers(n: int) -> np.ndarray:
    out = np.full(n, _BASE, np.uint64)
    out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


def letters(words: list[bytes]) -> np.ndarray:
    """Equally long Latin-1 words as a matrix of code points."""
    return np.frombuffer(b"".join(words), np.uint8).reshape(len(words), -1).astype(np.uint64)


def hashes(codes: np.ndarray) -> np.ndarray:
    return (codes * powers(codes.shape[1])).sum(axis=1, dtype=np.uint64)


class BlockedBloom:
    """Blocked Bloom filter of mixed hashes: a key belongs to one block of 256 bits and sets a bit in each of its 8 words. The
    filter of a word length is cut into parts of equally many blocks, which are built apart; ``first`` is the first that is
    here, of ``parts`` in all."""

    def __init__(self, blocks: np.ndarray, size: int, parts: int, first: int = 0):
        self.blocks, self.size, self.parts, self.first = blocks, size, parts, first

    @staticmethod
    def built(keys: np.ndarray, size: int) -> np.ndarray:
        """The blocks of one part from the keys that belong to it."""
        blocks = np.zeros((size, _LANES), np.uint32)
        at = BlockedBloom._inner(keys, size)
        for i in range(_LANES):
            np.bitwise_or.at(blocks[:, i], at, BlockedBloom._bit(keys, i))
        return blocks

    @staticmethod
    def part_of(keys: np.ndarray, parts) -> np.ndarray:
        return (keys % parts).astype(np.int64)

    @staticmethod
    def _inner(keys: np.ndarray, size: int) -> np.ndarray:
        return ((keys >> np.uint64(32)) * np.uint64(size) >> np.uint64(32)).astype(np.int64)

    @staticmethod
    def _bit(keys: np.ndarray, lane: int) -> np.ndarray:
        spread = (keys & np.uint64(0xFFFFFFFF)) * np.uint64(_SALTS[lane]) & np.uint64(0xFFFFFFFF)
        return np.uint32(1) << (spread >> np.uint64(27)).astype(np.uint32)

    def probe(self, keys: np.ndarray) -> np.ndarray:
        """Positions of the keys that may be in the filter; those of parts that are not here are left out."""
        part = self.part_of(keys, np.uint64(self.parts)) - self.first
        alive = np.flatnonzero((part >= 0) & (part < len(self.blocks) // self.size))
        at = part[alive] * self.size + self._inner(keys[alive], self.size)
        for i in range(_LANES):
            if not len(alive):
                break
            hit = np.flatnonzero(self.blocks[at, i] & self._bit(keys[alive], i))
            alive, at = alive[hit], at[hit]
        return alive


def edits(codes: np.ndarray, alphabet: np.ndarray, deletions: bool = True):
    """Hashes of the edits of equally long words, position by position: (kind, position, rows, letters, hashes). A run of equal
    letters is shortened once; a letter is replaced by greater ones only."""
    n, length = codes.shape
    power = powers(length)
    whole, before = hashes(codes), np.zeros(n, np.uint64)
    for i in range(length):
        upto = before + codes[:, i] * power[i]
        if deletions:
            rows = np.flatnonzero(codes[:, i] != codes[:, i - 1]) if i else np.arange(n)
            yield "delete", i, rows, None, before[rows] + (whole[rows] - upto[rows]) * _INVERSE
        rows, to = np.nonzero(alphabet[None, :] > codes[:, i, None])
        yield "replace", i, rows, alphabet[to], whole[rows] + (alphabet[to] - codes[rows, i]) * power[i]
        before = upto


def candidates(words: list[bytes], filters: dict[int, BlockedBloom], alphabet: np.ndarray, min_length: int):
    """(row, edit) for the edits of equally long words that a filter takes for words. ``filters``: by length; edits of lengths
    and parts that are not there are left to another pass."""
    codes, length = letters(words), len(words[0])
    for kind, i, rows, to, h in edits(codes, alphabet, length > min_length):
        f = filters.get(length - (kind == "delete"))
        if f is None or not len(rows):
            continue
        for at in f.probe(mixed(h)):
            w = words[rows[at]]
            middle = b"" if to is None else bytes([int(to[at])])
            yield int(rows[at]), w[:i] + middle + w[i + 1:]


def near_pairs(vocabulary: DataFrame, min_length: int = 5, part_words: int = 10_000, broadcast_bytes: int = 64 << 20,
               bits: int = 16) -> DataFrame:
    """(word, n, near, near_n): each pair of words of ``vocabulary`` (word, n; words distinct, of code points up to U+00FF and at
    least ``min_length`` of them) that one edit parts, once. A filter's parts hold about ``part_words`` words of one length,
    and each is built by a task; parts of up to ``broadcast_bytes`` in total are broadcast at a time, and more of them take
    more passes."""
    spark = vocabulary.sparkSession
    lengths = {r["len"]: r["count"] for r in vocabulary.groupBy(F.length("word").alias("len")).count().collect()}
    parts = {k: -(-n // part_words) for k, n in lengths.items()}
    blocks = {k: -(-n * bits // (parts[k] * 32 * _LANES)) for k, n in lengths.items()}  # of each part
    present = vocabulary.select(F.explode(F.array_distinct(F.split("word", ""))).alias("c")).distinct()
    alphabet = np.array(sorted(ord(r["c"]) for r in present.collect() if r["c"]), np.uint64)  # at most 256 letters

    def sharded(batches):
        for b in batches:
            words = [w.encode("latin-1") for w in b.column(0).to_pylist()]
            h = np.empty(len(words), np.uint64)
            size = np.array([len(w) for w in words], np.int64)
            for k in np.unique(size):
                at = np.flatnonzero(size == k)
                h[at] = mixed(hashes(letters([words[i] for i in at])))
            part = BlockedBloom.part_of(h, np.array([parts[k] for k in size.tolist()], np.uint64))
            yield pa.RecordBatch.from_arrays([pa.array(size), pa.array(part), pa.array(h.view(np.int64))], ["size", "part", "h"])

    def build(key, rows):
        filled = BlockedBloom.built(rows["h"].to_numpy().view(np.uint64), blocks[key[0]])
        return rows.iloc[:1].assign(filter=[filled.tobytes()])[["size", "part", "filter"]]

    built = (vocabulary.select("word").mapInArrow(sharded, "size bigint, part bigint, h bigint")
             .groupBy("size", "part").applyInPandas(build, "size bigint, part bigint, filter binary"))
    built = materialise(built, "spelling-filters")
    passes: list[dict[int, range]] = []  # parts of each length
    room = 0
    for k in sorted(parts):
        at, each = 0, blocks[k] * 4 * _LANES
        while at < parts[k]:
            if not passes or room < each:
                passes.append({})
                room = broadcast_bytes
            many = min(parts[k] - at, max(1, room // each))
            passes[-1][k] = range(at, at + many)
            at, room = at + many, room - many * each
    found = spark.createDataFrame([], "word string, n bigint, edit string")
    for here in passes:
        held = {k: BlockedBloom(np.zeros((len(r) * blocks[k], _LANES), np.uint32), blocks[k], parts[k], r.start) for k, r in here.items()}
        wanted = F.lit(False)
        for k, r in here.items():
            wanted = wanted | ((F.col("size") == k) & F.col("part").between(r.start, r.stop - 1))
        for row in built.filter(wanted).toLocalIterator():  # at most broadcast_bytes, and one part
            f, at = held[row["size"]], (row["part"] - here[row["size"]].start) * blocks[row["size"]]
            f.blocks[at:at + f.size] = np.frombuffer(row["filter"], np.uint32).reshape(-1, _LANES)
        shared = spark.sparkContext.broadcast(held)

        def probe(batches, shared=shared):
            for b in batches:
                words = [w.encode("latin-1") for w in b.column(0).to_pylist()]
                counts = b.column(1).to_pylist()
                by_length: dict[int, list[int]] = {}
                for i, w in enumerate(words):
                    by_length.setdefault(len(w), []).append(i)
                out: tuple[list, list, list] = ([], [], [])
                for at in by_length.values():
                    for i, edit in candidates([words[i] for i in at], shared.value, alphabet, min_length):
                        out[0].append(words[at[i]].decode("latin-1"))
                        out[1].append(counts[at[i]])
                        out[2].append(edit.decode("latin-1"))
                        if len(out[0]) >= 1 << 16:
                            yield pa.RecordBatch.from_arrays([pa.array(x) for x in out], ["word", "n", "edit"])
                            out = ([], [], [])
                if out[0]:
                    yield pa.RecordBatch.from_arrays([pa.array(x) for x in out], ["word", "n", "edit"])

        asking = vocabulary.filter(F.length("word").isin(sorted({*here, *(k + 1 for k in here)}))).select("word", "n")
        found = found.union(asking.mapInArrow(probe, "word string, n bigint, edit string"))
    real = vocabulary.select(F.col("word").alias("near"), F.col("n").alias("near_n"))
    return found.join(real, F.col("edit") == F.col("near")).select("word", "n", "near", "near_n")


def roots(linked: DataFrame) -> DataFrame:
    """(word, root): ``linked`` (word, form) followed to the last form. Forms must not form a circle. A round joins the words
    whose form got its root in the round before; a form has no more words than it has neighbours, so no key is hot."""
    frontier = materialise(linked.filter("form IS NULL").select("word", F.col("word").alias("root")), "spelling-roots")
    rest, done = linked.filter("form IS NOT NULL").select(F.col("word").alias("next"), "form"), []
    while True:
        done.append(frontier)
        frontier = materialise(rest.join(frontier, F.col("form") == F.col("word")).select(F.col("next").alias("word"), "root"),
                               "spelling-roots")
        if frontier.isEmpty():
            break
    out = done[0]
    for d in done[1:]:
        out = out.union(d)
    return out


def spelling_forms(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", drop: int = 97, min_length: int = 5,
                   min_count: int = 3, ratio: int = 2, **sizes) -> DataFrame:
    """A row for each word of at least ``min_length`` code points and ``min_count`` occurrences in the texts: word, form, root, n,
    n_near, form_n.

    Words are near if one inserted, deleted or replaced code point parts them. The form is the near word that occurs
    most (ties: the smallest in code-point order) if it occurs ``ratio`` times as often at least, else null; form_n is
    its count. The root is the last of the chain of forms, the word itself where it has none. ``ratio`` above 1 rules out
    circles. Null and empty texts have no words, repeated rows count each time, other columns are not read, and an
    empty table gives no rows. ``sizes``: those of ``near_pairs``.
    """
    if ratio <= 1:
        raise ValueError("ratio must be above 1")
    vocabulary = materialise(word_counts(docs, id_col, text_col, drop, min_length).filter(F.col("n") >= min_count), "spelling-words")
    pairs = materialise(near_pairs(vocabulary, min_length, **sizes), "spelling-pairs")
    both = pairs.select("word", "near", "near_n").union(pairs.select("near", "word", "n"))
    best = both.groupBy("word").agg(F.count("*").alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("less"), "near")).alias("best"))
    fits = -F.col("best.less") >= ratio * F.col("n")
    linked = vocabulary.join(best, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), F.when(fits, F.col("best.near")).alias("form"),
        F.when(fits, -F.col("best.less")).alias("form_n"))
    linked = materialise(linked, "spelling-forms")
    return linked.join(roots(linked), "word").select("word", "form", "root", "n", "n_near", "form_n")
