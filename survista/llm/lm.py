"""Language-model scores from a log-frequency Bloom filter.

Texts are read once into *chunks*: rows that hold the tokens of some documents as places in the chunk's own list of
distinct words. Everything a chunk needs from the corpus comes back to it as arrays in the order of that list, so what is
shuffled is distinct words and word pairs of chunks, packed by *shard* (a range of 64-bit keys), never single tokens.
A shard adds up its keys, builds its filter and probes each distinct key once, whatever number of chunks has it; the
chunks themselves are kept in buckets and stay where they are. Words are told apart by their 64-bit XXH3.
"""

from __future__ import annotations

from itertools import pairwise

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from survista.llm.common import materialise

#: Key of the end token. Words are never empty.
END = xxhash.xxh3_64_intdigest(b"")
_U = np.uint64


def token_lists(text: pa.Array) -> pa.Array:
    """Tokens of each text: its words after lower-casing A-Z, parted at \\x20 and \\x09-\\x0D, and the end token, an empty
    word. Null is the empty text."""
    empty, space = pa.scalar("", text.type), pa.scalar(" ", text.type)
    text = pc.ascii_trim_whitespace(pc.ascii_lower(pc.fill_null(text, empty)))
    return pc.ascii_split_whitespace(pc.if_else(pc.equal(text, empty), text, pc.binary_join_element_wise(text, empty, space)))


def _mixed(x: np.ndarray, salt: int) -> np.ndarray:
    """A 64-bit mix (the finaliser of SplitMix64) of x + salt steps."""
    x = x + _U(salt * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF)
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


#: Bits of the keys of words and of pairs. Word keys decide the exact counts; a pair key that is shared raises a count as
#: a wrong bit of the filter does, and far less often.
WIDTH = {1: 64, 2: 48}


def pair_keys(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    return (_mixed(first, 1) ^ _mixed(second, 2) * _U(0x9E3779B97F4A7C15)) >> _U(64 - WIDTH[2])


def packed(keys: np.ndarray, spans: list[tuple[int, int]]) -> list[bytes]:
    """Of each span of sorted keys, none empty and each begun where the one before ends, the keys by their distances, 32 bits
    each; those that take more stand in front in full, and so does the first. The spans share the array operations: a
    chunk has a span for each shard, so nearly all of them are short."""
    step = np.diff(keys, prepend=_U(0))
    starts = np.array([a for a, _ in spans], np.int64)
    step[starts] = keys[starts]
    wide = np.flatnonzero(step >= _U(0xFFFFFFFF))
    cuts = np.searchsorted(wide, [*starts.tolist(), len(keys)]).tolist()
    heads, near = step[wide].astype("<u8").tobytes(), np.minimum(step, _U(0xFFFFFFFF)).astype("<u4").tobytes()
    return [(j - i).to_bytes(8, "little") + heads[8 * i:8 * j] + near[4 * a:4 * z] for (a, z), (i, j) in zip(spans, pairwise(cuts), strict=True)]


def unpacked(data: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The keys of all spans, and where each span ends."""
    fronts = [8 + 8 * int.from_bytes(x[:8], "little") for x in data]
    step = np.frombuffer(b"".join(x[n:] for x, n in zip(data, fronts, strict=True)), "<u4").astype(np.uint64)
    step[step == _U(0xFFFFFFFF)] = np.frombuffer(b"".join(x[8:n] for x, n in zip(data, fronts, strict=True)), "<u8")
    ends = np.cumsum([(len(x) - n) // 4 for x, n in zip(data, fronts, strict=True)])
    keys = np.cumsum(step, dtype=np.uint64)
    keys -= np.repeat(np.append(_U(0), keys[ends[:-1] - 1]), np.diff(ends, prepend=0))  # each span begins anew
    return keys, ends


class LogFrequencyBloom:
    """Counts of 64-bit keys, quantised to levels 1 + floor(log_base(count)); a key of level q is held q times, as (key, 1)
    to (key, q). A lookup probes level after level until one is missing: it never finds less than the level put in."""

    def __init__(self, bits: np.ndarray, size: int, hashes: int, base: float):
        self.bits, self.size, self.hashes, self.base = bits, size, hashes, base

    @staticmethod
    def levels_of(counts: np.ndarray, base: float) -> np.ndarray:
        edges = LogFrequencyBloom.edges(base)
        return np.searchsorted(edges, counts, side="right")

    @staticmethod
    def edges(base: float) -> np.ndarray:
        """Smallest count of each level."""
        return np.unique(np.ceil(base ** np.arange(0, int(62 / np.log2(base)))).astype(np.int64))

    @staticmethod
    def estimates(base: float) -> np.ndarray:
        """Count that stands for each level: 0, then the middle of its counts."""
        e = LogFrequencyBloom.edges(base)
        return np.concatenate(([0.0], (e[:-1] + e[1:] - 1) / 2, [float(e[-1])]))

    @classmethod
    def of(cls, keys: np.ndarray, counts: np.ndarray, hashes: int = 6, base: float = 1.5) -> LogFrequencyBloom:
        level = cls.levels_of(counts, base)
        size = max(64, int(np.ceil(level.sum() * hashes / np.log(2))))
        if size >> 32:
            raise ValueError("a filter holds fewer than 2**32 bits; lower shard_tokens")
        self = cls(np.zeros(0, np.uint8), size, hashes, base)
        flags = np.zeros(size, bool)
        for j in range(1, int(level.max(initial=0)) + 1):
            held = keys[level >= j]
            for i in range(0, len(held), _AT_ONCE):
                for at in self._places(held[i:i + _AT_ONCE], j):
                    flags[at] = True
        self.bits = np.packbits(flags, bitorder="little")
        return self

    def _places(self, keys: np.ndarray, level: int):
        """Bit of each key under each hash (double hashing)."""
        a, step = _mixed(keys, 2 * level + 3), _mixed(keys, 2 * level + 4) | _U(1)
        for i in range(self.hashes):
            yield _spread(a + _U(i) * step, _U(self.size)).astype(np.int64)

    def lookup(self, keys: np.ndarray) -> np.ndarray:
        """Level of each key, 0 if it is not held."""
        return _levels(keys, self.bits, self.hashes, np.broadcast_to(_U(self.size), len(keys)), np.broadcast_to(_U(0), len(keys)))


class FilterShards:
    """The filters of all shards as one array of bits, so that a chunk's keys are probed together, however many shards
    there are. filters: size and bits by shard; a shard without keys may be missing."""

    def __init__(self, filters: dict[int, tuple[int, bytes]], shard_bits: int, order: int, hashes: int):
        self.shift, self.hashes = WIDTH[order] - shard_bits if shard_bits else None, hashes
        self.size, self.first = np.zeros(1 << shard_bits, np.uint64), np.zeros(1 << shard_bits, np.uint64)
        at = 0
        for s, (size, bits) in filters.items():
            self.size[s], self.first[s] = size, 8 * at
            at += len(bits)
        self.bits = np.frombuffer(b"".join(bits for _, bits in filters.values()), np.uint8)

    def lookup(self, keys: np.ndarray) -> np.ndarray:
        shard = np.zeros(len(keys), np.int64) if self.shift is None else (keys >> _U(self.shift)).astype(np.int64)
        return _levels(keys, self.bits, self.hashes, self.size[shard], self.first[shard])


def _spread(h: np.ndarray, size) -> np.ndarray:
    """Hashes to places below ``size``, a number below 2**32."""
    return ((h >> _U(32)) * size) >> _U(32)


#: Keys that are hashed together: as many as the processor's caches hold with what they become on the way.
_AT_ONCE = 1 << 16


def _levels(keys: np.ndarray, bits: np.ndarray, hashes: int, size: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Level of each key in the filter that has ``size`` bits from bit ``first`` on; 0 without one."""
    level = np.zeros(len(keys), np.uint8)
    for i in range(0, len(keys), _AT_ONCE):
        at = slice(i, i + _AT_ONCE)
        _probe(keys[at], bits, hashes, size[at], first[at], level[at])
    return level


def _probe(keys: np.ndarray, bits: np.ndarray, hashes: int, size: np.ndarray, first: np.ndarray, level: np.ndarray) -> None:
    live, j = np.flatnonzero(size), 0
    while len(live) and j < 255:
        j += 1
        a, step = _mixed(keys[live], 2 * j + 3), _mixed(keys[live], 2 * j + 4) | _U(1)
        n, start = size[live], first[live]
        for _ in range(hashes):
            at = _spread(a, n) + start
            hit = np.flatnonzero((bits[(at >> _U(3)).view(np.int64)] >> (at & _U(7)).astype(np.uint8)) & 1)
            if len(hit) < len(live):
                live, a, step, n, start = live[hit], a[hit], step[hit], n[hit], start[hit]
            a = a + step
        level[live] = j


def _shards(keys: np.ndarray, bits: int, order: int):
    """(shard, first, end) of sorted keys: the ranges by their leading bits."""
    if not bits:
        return [(0, 0, len(keys))] if len(keys) else []
    shard = (keys >> _U(WIDTH[order] - bits)).astype(np.int64)
    cuts = np.flatnonzero(np.append(True, shard[1:] != shard[:-1])[:len(shard)])
    return [(int(shard[a]), int(a), int(z)) for a, z in zip(cuts, [*cuts[1:], len(shard)], strict=True)]


def _narrow(counts: np.ndarray, spans: list[tuple[int, int]]) -> list[bytes]:
    """Counts of each span in the fewest bytes each that hold them all; the first byte tells how many."""
    most = np.maximum.reduceat(counts, [a for a, _ in spans])
    kinds = (1 << np.searchsorted([1 << 8, 1 << 16, 1 << 32], most, side="right")).tolist()
    data = {k: counts.astype(f"<u{k}").tobytes() for k in set(kinds)}
    return [bytes((k,)) + data[k][k * a:k * z] for k, (a, z) in zip(kinds, spans, strict=True)]


def _widened(data: list[bytes]) -> np.ndarray:
    if all(x[0] == 1 for x in data):
        return np.frombuffer(b"".join(x[1:] for x in data), np.uint8).astype(np.int64)
    return np.concatenate([np.frombuffer(x, f"<u{x[0]}", -1, 1).astype(np.int64) for x in data])


def _grouped(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct keys, sorted, the sum of each one's counts, and each key's place among them."""
    order = np.argsort(keys)
    k = keys[order]
    new = np.append(True, k[1:] != k[:-1])[:len(k)]
    first = np.flatnonzero(new)
    total = np.add.reduceat(counts[order], first) if len(first) else np.zeros(0, np.int64)
    place = np.empty(len(k), np.int32)
    place[order] = np.cumsum(new, dtype=np.int32) - 1
    return k[first], total, place


def _place_type(words: int):
    return np.uint16 if words <= 1 << 16 else np.uint32


def _parts(batch: pa.RecordBatch, size: int = 1 << 23):
    """Slices of a batch by about ``size`` bytes of the texts in its second column."""
    ends = np.cumsum(pc.fill_null(pc.binary_length(batch.column(1)), 0).to_numpy().astype(np.int64))
    cuts = np.flatnonzero(np.diff(ends // size)) + 1
    for a, z in pairwise([0, *cuts.tolist(), batch.num_rows]):
        yield batch.slice(a, z - a)


def _word_keys(words: pa.Array) -> np.ndarray:
    """XXH3 of words, without a Python object for each but its bytes."""
    words = words.cast(pa.large_string())
    spans = np.frombuffer(words.buffers()[1], np.int64, len(words) + 1, 8 * words.offset).tolist()
    data = words.buffers()[2].to_pybytes() if spans[-1] else b""
    return np.fromiter((xxhash.xxh3_64_intdigest(data[a:z]) for a, z in pairwise(spans)), np.uint64, len(words))


def in_chunks(docs: DataFrame, learn: F.Column, id_col: str, text_col: str, chunk_tokens: int) -> DataFrame:
    """(chunk, ids, learn, lengths, n, keys, places, seen): documents of a task, about ``chunk_tokens`` tokens together. keys
    has the distinct words' keys, sorted; places the tokens as places there; seen each word's count in documents to
    learn from; lengths the documents' tokens, their ends included."""
    spec = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"), learn.alias("learn"))
    kind = spec.schema["id"].dataType.simpleString()

    def read(batches):
        task, chunk = TaskContext.get().partitionId(), 0
        names, flags, lengths, toks, held = [], [], [], [], 0

        def row(ktype):
            coded = pa.concat_arrays(toks).dictionary_encode()
            keys, back = np.unique(_word_keys(coded.dictionary), return_inverse=True)
            places = back.astype(_place_type(len(keys)))[coded.indices.to_numpy()]
            learnt = np.repeat(np.array(flags, bool), lengths)
            seen = np.bincount(places[learnt], minlength=len(keys)).astype(np.uint32)
            return pa.RecordBatch.from_arrays(
                [pa.array([task << 32 | chunk]), pa.array([names], pa.list_(ktype)), pa.array([flags], pa.list_(pa.bool_())),
                 pa.array([lengths], pa.list_(pa.int64())), pa.array([held]),
                 *(pa.array([x.tobytes()], pa.binary()) for x in (keys, places, seen))],
                ["chunk", "ids", "learn", "lengths", "n", "keys", "places", "seen"])

        for b in batches:
            ktype = b.column(0).type
            for part in _parts(b):
                lists = token_lists(part.column(1))
                words, n = lists.flatten(), lists.value_lengths().to_numpy().astype(np.int64)
                name, flag, ends, at = part.column(0).to_pylist(), part.column(2).to_pylist(), np.cumsum(n), 0
                while at < len(n):
                    done = int(ends[at - 1]) if at else 0
                    to = min(int(np.searchsorted(ends, done + chunk_tokens - held)) + 1, len(n))
                    toks.append(words.slice(done, int(ends[to - 1]) - done))
                    names += name[at:to]
                    flags += flag[at:to]
                    lengths += n[at:to].tolist()
                    held, at = held + int(ends[to - 1]) - done, to
                    if held >= chunk_tokens:
                        yield row(ktype)
                        names, flags, lengths, toks, held, chunk = [], [], [], [], 0, chunk + 1
        if names:
            yield row(ktype)

    return spec.mapInArrow(read, f"chunk bigint, ids array<{kind}>, learn array<boolean>, lengths array<bigint>, n bigint, keys binary, places binary, seen binary")


class _Chunk:
    """A chunk's arrays, from a row as a dict."""

    def __init__(self, r: dict):
        self.keys = np.frombuffer(r["keys"], np.uint64)
        self.places = np.frombuffer(r["places"], _place_type(len(self.keys)))
        self.lengths = np.asarray(r["lengths"], np.int64)
        self.ends = np.cumsum(self.lengths)

    def pairs(self) -> tuple[np.ndarray, np.ndarray]:
        """Distinct pair keys, sorted, and the place of each token's pair; an end stands before a document's first word."""
        before = np.empty(len(self.places), np.uint64)
        word = self.keys[self.places]
        before[1:] = word[:-1]
        before[self.ends - self.lengths] = _U(END)
        return np.unique(pair_keys(before, word), return_inverse=True)


#: Keys that a task adds up before it sends them (fewer where their counts would outgrow 32 bits).
_HELD = 1 << 21


def _routes(chunks: DataFrame, shard_bits: int, order: int, learn: bool) -> DataFrame:
    """(shard, chunk, keys, counts): of words (order 1) or pairs (order 2), the keys of each chunk in each shard; with
    ``learn`` only those seen in documents to learn from, and those of a task's chunks added up until they are ``_HELD``:
    a key that every chunk has then comes from few rows."""
    def split(batches):
        held: tuple[list, list] = ([], [])

        def routed(chunk, keys, seen):
            parts = _shards(keys, shard_bits, order)
            if parts:
                spans, data = [x[1:] for x in parts], keys.tobytes()
                yield pa.RecordBatch.from_arrays(
                    [pa.array([s for s, _, _ in parts]), pa.array([chunk] * len(parts), pa.int64()),
                     pa.array(packed(keys, spans) if order == 2 else [data[8 * a:8 * z] for a, z in spans], pa.binary()),
                     pa.array(_narrow(seen, spans), pa.binary())], ["shard", "chunk", "keys", "counts"])

        def added():
            keys, seen, _ = _grouped(np.concatenate(held[0]), np.concatenate(held[1]).astype(np.int64))
            held[0].clear()
            held[1].clear()
            return keys, seen

        for b in batches:
            for i in range(b.num_rows):
                r = b.slice(i, 1).to_pylist()[0]
                if order == 1:
                    keys, seen = np.frombuffer(r["keys"], np.uint64), np.frombuffer(r["seen"], np.uint32)
                else:
                    c = _Chunk(r)
                    keys, back = c.pairs()
                    learnt = np.repeat(np.asarray(r["learn"], bool), c.lengths)
                    seen = np.bincount(back[learnt], minlength=len(keys)).astype(np.uint32)
                if not learn:
                    yield from routed(r["chunk"], keys, seen)
                    continue
                held[0].append(keys[seen > 0])
                held[1].append(seen[seen > 0])
                if sum(map(len, held[0])) > _HELD or sum(int(x.sum()) for x in held[1]) >> 31:
                    yield from routed(None, *added())
        if held[0]:
            yield from routed(None, *added())

    cols = ["chunk", "keys", "seen"] if order == 1 else ["chunk", "lengths", "learn", "keys", "places"]
    return chunks.select(*cols).mapInArrow(split, "shard bigint, chunk bigint, keys binary, counts binary")


def _arrays(rows: pd.DataFrame, order: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Keys and counts of all routes, and where each route ends."""
    data = rows["keys"].tolist()
    keys, ends = unpacked(data) if order == 2 else (np.frombuffer(b"".join(data), np.uint64), np.cumsum([len(x) // 8 for x in data]))
    return keys, _widened(rows["counts"].tolist()), ends


def count_shard(key: tuple, rows: pd.DataFrame, order: int, hashes: int, base: float) -> pd.DataFrame:
    """What ``counted`` has of a shard; rows: its routes, of all chunks."""
    keys, counts, ends = _arrays(rows, order)
    known, total, place = _grouped(keys, counts)
    spans = list(pairwise([0, *ends.tolist()]))
    level = LogFrequencyBloom.of(known[total > 0], total[total > 0], hashes, base).lookup(known)[place].tobytes()
    exact = _narrow(total[place], spans) if order == 1 else None
    out = pd.DataFrame({"chunk": rows["chunk"].astype("Int64"), "shard": key[0], "order": order, "counts": exact,
                        "levels": [level[a:z] for a, z in spans], "total": 0, "distinct": 0})
    whole = pd.DataFrame({"chunk": pd.array([None], "Int64"), "shard": key[0], "order": order, "counts": None,
                          "levels": None, "total": int(total.sum()), "distinct": int((total > 0).sum())})
    return pd.concat([whole, out], ignore_index=True)


def counted(chunks: DataFrame, shard_bits: int, order: int, hashes: int, base: float) -> DataFrame:
    """(chunk, shard, order, counts, levels, total, distinct): for each chunk the levels of its words (order 1) or pairs (2)
    in a shard that probing the shard's filter gives, in the order of its keys, and the corpus counts of words; and for each
    shard a row without chunk, with the number of tokens and of distinct keys seen."""
    def count(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        return count_shard(key, rows, order, hashes, base)

    return _routes(chunks, shard_bits, order, False).groupBy("shard").applyInPandas(
        count, "chunk bigint, shard bigint, order int, counts binary, levels binary, total bigint, distinct bigint")


def pair_filters(chunks: DataFrame, shard_bits: int, hashes: int, base: float) -> DataFrame:
    """(shard, size, bits): a filter for each shard with the counts of pairs seen in documents to learn from."""
    def build(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        f = LogFrequencyBloom.of(*_grouped(*_arrays(rows, 2)[:2])[:2], hashes, base)
        return pd.DataFrame({"shard": [key[0]], "size": [f.size], "bits": [f.bits.tobytes()]})

    return _routes(chunks, shard_bits, 2, True).groupBy("shard").applyInPandas(build, "shard bigint, size bigint, bits binary")


def _score_chunk(c: _Chunk, counts: np.ndarray, words: np.ndarray, pairs: np.ndarray, pair_at: np.ndarray, n: int, v: int, base: float, strength: float):
    """n_known, base score and model score of each document. words, pairs: levels found by probing."""
    first = c.ends - c.lengths
    known = np.add.reduceat((counts > 0)[c.places].astype(np.int64), first)
    plain = np.log10((counts + 1.0) / (n + v + 1.0))[c.places]
    value = LogFrequencyBloom.estimates(base)
    word = value[words]
    one = (word + 1.0) / (n + v + 1.0)
    context = np.empty(len(c.places))
    context[1:] = word[c.places[:-1]]
    context[first] = word[np.searchsorted(c.keys, _U(END))]  # an end is among the words of every chunk
    two = np.minimum(value[pairs[pair_at]], context)
    smooth = np.log10((two + strength * one[c.places]) / (context + strength))
    return known, np.add.reduceat(plain, first), np.add.reduceat(smooth, first)


def score(docs: DataFrame, learn: F.Column, id_col: str = "doc_id", text_col: str = "text", hashes: int = 6, base: float = 1.5,
          strength: float = 64.0, chunk_tokens: int = 1 << 18, shard_tokens: int = 1 << 22,
          broadcast_bytes: int = 256 << 20) -> DataFrame:
    """One row per row of ``docs``: id_col, n_tokens, n_known, train_tokens, base_score, score.

    Learns from the rows where ``learn`` holds (null: does not). base_score sums log10((c+1)/(N+V+1)) over the tokens, with
    exact counts. score sums log10 P(w|u), P(w|u) = (c'(u,w) + strength * P(w)) / (c'(u) + strength), P(w) = (c'(w)+1)/(N+V+1),
    where c' are the counts that probing the filter gives and u is the token before w, an end before the first. Null
    and empty texts are one end token. Rows with null or repeated ids are scored like others; an empty table gives none.

    The filter is built in shards, each from the keys that the chunks send there, and the levels come back to the chunks. Where
    it cannot take more than ``broadcast_bytes`` (as if each token were a new word and a new pair), the pairs are added up
    in the tasks instead, and the pairs' filter is broadcast. Both ways probe the same bits and give the same scores.
    """
    spark = docs.sparkSession
    kind = docs.schema[id_col].dataType.simpleString()
    chunks = materialise(in_chunks(docs, F.coalesce(learn, F.lit(False)), id_col, text_col, chunk_tokens), "lm-chunks", "chunk")
    tokens_all = chunks.agg(F.sum("n")).first()[0] or 0
    shard_bits = max(0, (tokens_all // shard_tokens).bit_length())
    small = 2 * tokens_all * hashes / np.log(2) / 8 <= broadcast_bytes
    back = counted(chunks, shard_bits, 1, hashes, base)
    held = None
    if small:
        pairs = materialise(pair_filters(chunks, shard_bits, hashes, base), "lm-pairs")
        read = {r.shard: (r["size"], bytes(r.bits)) for r in pairs.toLocalIterator()}  # at most broadcast_bytes
        held = spark.sparkContext.broadcast(FilterShards(read, shard_bits, 2, hashes))
        del read
    else:
        back = back.union(counted(chunks, shard_bits, 2, hashes, base))
    back = materialise(back, "lm-counted")
    n, v = back.filter((F.col("order") == 1) & F.col("chunk").isNull()).agg(F.coalesce(F.sum("total"), F.lit(0)), F.coalesce(F.sum("distinct"), F.lit(0))).first()

    def finish(key: tuple, rows: pd.DataFrame, found: pd.DataFrame) -> pd.DataFrame:
        r = rows.iloc[0].to_dict()
        c = _Chunk(r)
        pair_keys_, pair_at = c.pairs()
        one, two = (found[found["order"] == order].sort_values("shard") for order in (1, 2))
        counts, words = _widened(one["counts"].tolist()), np.frombuffer(b"".join(one["levels"]), np.uint8)
        pairs = held.value.lookup(pair_keys_) if small else np.frombuffer(b"".join(two["levels"]), np.uint8)
        known, plain, smooth = _score_chunk(c, counts, words, pairs, pair_at, n, v, base, strength)
        return pd.DataFrame({"id": pd.array(r["ids"], dtype=pd_kind), "n_tokens": c.lengths, "n_known": known, "train_tokens": n, "base_score": plain, "score": smooth})

    pd_kind = "Int64" if kind in ("bigint", "int") else object
    back = back.filter("chunk is not null").select("chunk", "shard", "order", "counts", "levels")
    out = chunks.select("chunk", "ids", "lengths", "keys", "places").groupBy("chunk").cogroup(back.groupBy("chunk")).applyInPandas(
        finish, f"id {kind}, n_tokens bigint, n_known bigint, train_tokens bigint, base_score double, score double")
    return out.withColumnRenamed("id", id_col)
