"""Benchmark passages in training text: BM25 retrieval of test items by block-max WAND, then overlap of question and answer.

Items are indexed in blocks of bounded text, one broadcast index after the other; every document is the query of each.
An item is found if ``share`` of the five-word shingles of its question and of its answer stand in one passage, or the
same share of those of the whole item, where one word more or less decides over a short answer. Passages are as wide as the
longest item of all blocks asks for. Each item's retrieval threshold follows from that: a passage that passes lacks at most
one word for each missing shingle, so its BM25 score is at least the item's own score less its heaviest words, as many as
shingles may be missing.
"""

from __future__ import annotations

from array import array
from bisect import bisect_left
from itertools import repeat
from operator import itemgetter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from survista.llm.common import materialise, utf8
from survista.llm.licences import words

K1, B = 1.2, 0.75
#: Postings that share one block maximum.
BLOCK = 8


def shingles(ws: list[bytes], width: int) -> set[bytes]:
    """Runs of ``width`` words; of all the words if they are fewer; none without words."""
    if not ws:
        return set()
    n = max(1, len(ws) - width + 1)
    return {b" ".join(ws[i:i + width]) for i in range(n)}


class Index:
    """Inverted index of items with impacts scaled so that each item's threshold is 1, and their maxima by term and block."""

    def __init__(self, items: list[tuple], df: dict[bytes, int], n_items: int, mean_length: float, longest: int, share: float, width: int):
        """items: (item id, words of the question, words of the answer). n_items, mean_length, longest: of all blocks."""
        self.width, self.share, self.longest = width, share, longest
        self.items, self.parts = [], []
        self.ids: dict[bytes, int] = {}
        rows: list[tuple[int, int, float]] = []
        self.unit: list[float] = []
        for name, question, answer in items:
            ws = question + answer
            if not ws:
                continue
            q, a, both = shingles(question, width), shingles(answer, width), shingles(ws, width)
            tf: dict[bytes, int] = {}
            for w in ws:
                tf[w] = tf.get(w, 0) + 1
            norm = K1 * (1 - B + B * len(ws) / mean_length)
            weight = {w: np.log1p((n_items - df[w] + 0.5) / (df[w] + 0.5)) * n * (K1 + 1) / (n + norm) for w, n in tf.items()}
            # A word that is gone begins or ends a missing shingle; twice as many may be where shingles repeat.
            lack = [int(len(s) * (1 - share) + 1e-9) * (1 + (len(p) - width + 1 > len(s))) for s, p in ((q, question), (a, answer), (both, ws))]
            missing = max(lack[0] + lack[1], lack[2])
            heaviest = sorted(weight.values(), reverse=True)[:missing]
            least = max(sum(weight.values()) - sum(heaviest), min(weight.values())) * (1 - 1e-9)
            k = len(self.items)
            self.items.append(name)
            self.parts.append((q, a, both))
            self.unit.append(least)
            rows += [(self.ids.setdefault(w, len(self.ids)), k, x / least) for w, x in weight.items()]
        rows.sort()
        term, self.item, self.impact = (np.array(c) for c in zip(*rows, strict=True)) if rows else (np.zeros(0, int), np.zeros(0, int), np.zeros(0))
        self.first = np.searchsorted(term, np.arange(len(self.ids) + 1))
        self.top = np.maximum.reduceat(self.impact, self.first[:-1]) if len(rows) else np.zeros(0)
        # By term and block of items: the largest impact there.
        cell = term * (len(self.items) // BLOCK + 1) + self.item // BLOCK
        start = np.flatnonzero(np.append(True, cell[1:] != cell[:-1])[:len(cell)])
        self.cell_block = (self.item // BLOCK)[start]
        self.cell_top = np.maximum.reduceat(self.impact, start) if len(start) else np.zeros(0)
        self.cell_first = np.searchsorted(term[start], np.arange(len(self.ids) + 1))
        # The same for WAND, which looks up one number at a time.
        self.lists = tuple(array(kind, x.tolist()) for kind, x in (
            ("q", self.first), ("q", self.item), ("d", self.impact), ("d", self.top), ("q", self.cell_first), ("q", self.cell_block), ("d", self.cell_top)))

    def hits(self, text: bytes) -> list[tuple]:
        """(item id, score, question overlap, answer overlap, first word of the passage), once for each item found in the
        text, where it overlaps most. Passages are ``2 * longest`` words, each ``longest`` after the one before, so every
        run of ``longest`` words lies in one."""
        ws = words(text)
        if not ws or not self.items:
            return []
        ids = np.fromiter(map(self.ids.get, ws, repeat(-1)), np.int64, len(ws))
        at = np.flatnonzero(ids >= 0)
        half, n = self.longest, len(self.ids)
        pairs = np.unique(at // half * n + ids[at])  # distinct terms of each half passage
        if not len(pairs):
            return []
        seg, term = pairs // n, pairs % n
        halves = int(seg[-1]) + 1
        # Upper bound of each passage over all items; terms of both halves count twice, which only loosens it.
        bound = np.bincount(seg, self.top[term], halves + 1)
        passages = np.flatnonzero(bound[:-1] + bound[1:] >= 1)
        if not len(passages):
            return []
        # The same bound for each block of items.
        live = np.zeros(halves + 2, bool)
        live[passages] = live[passages + 1] = True
        keep = live[seg]
        s, t = seg[keep], term[keep]
        size = self.cell_first[t + 1] - self.cell_first[t]
        cells = np.repeat(self.cell_first[t] - np.cumsum(size) + size, size) + np.arange(size.sum())
        blocks = len(self.items) // BLOCK + 1
        by_block = np.bincount(np.repeat(s, size) * blocks + self.cell_block[cells], self.cell_top[cells], (halves + 2) * blocks).reshape(-1, blocks)
        passages = passages[((by_block[passages] + by_block[passages + 1]) >= 1).any(axis=1)]
        best: dict[int, tuple] = {}
        cuts = np.searchsorted(seg, np.arange(halves + 2))
        for p in passages.tolist():
            terms = np.unique(term[cuts[p]:cuts[min(p + 2, halves + 1)]])
            made: dict[int, set[bytes]] = {}
            for k, score in self.wand(terms.tolist()):
                q, a, both = (_overlap(part, ws[p * half:(p + 2) * half], made) for part in self.parts[k])
                if (min(q, a) >= self.share or both >= self.share) and (k not in best or (q + a) > best[k][1] + best[k][2]):
                    best[k] = score * self.unit[k], q, a, p * half
        return [(self.items[k], *v) for k, v in sorted(best.items())]

    def wand(self, terms: list[int]) -> list[tuple[int, float]]:
        """Items whose impacts for ``terms`` sum to 1 or more, by block-max WAND: lists are kept in the order of their current
        item; the pivot is the first item that the lists up to it could bring to 1; if the maxima of its block cannot, all
        of them skip the block."""
        first, item, impact, top, cell_first, cell_block, cell_top = self.lists
        lists = [[item[first[t]], first[t], first[t + 1], top[t], t] for t in terms]  # current item, place, end, largest impact, term
        lists.sort(key=itemgetter(0))
        found = []
        while lists:
            total, pivot = 0.0, -1
            for i, x in enumerate(lists):
                total += x[3]
                if total >= 1:
                    pivot = i
                    break
            if pivot < 0:
                break
            target = lists[pivot][0]
            while pivot + 1 < len(lists) and lists[pivot + 1][0] == target:
                pivot += 1
            ahead, block, bound = lists[:pivot + 1], target // BLOCK, 0.0
            for x in ahead:
                z = cell_first[x[4] + 1]
                j = bisect_left(cell_block, block, cell_first[x[4]], z)
                if j < z and cell_block[j] == block:
                    bound += cell_top[j]
            if bound < 1:  # skip the block, but not past an item at which another list comes in
                after = (block + 1) * BLOCK
                if pivot + 1 < len(lists):
                    after = min(after, lists[pivot + 1][0])
            else:
                after, score = target + 1, 0.0
                for x in ahead:
                    j = bisect_left(item, target, x[1], x[2])
                    if j < x[2] and item[j] == target:
                        score += impact[j]
                if score >= 1:
                    found.append((target, score))
            moved = []
            for x in ahead:
                j = bisect_left(item, after, x[1], x[2])
                if j < x[2]:
                    x[0], x[1] = item[j], j
                    moved.append(x)
            lists = sorted(moved + lists[pivot + 1:], key=itemgetter(0))
        return found


def _overlap(part: set[bytes], ws: list[bytes], made: dict[int, set[bytes]]) -> float:
    """Share of an item's shingles that stand in a passage; 1 without any. made: the passage's shingles by width."""
    if not part:
        return 1.0
    width = next(iter(part)).count(b" ") + 1
    if width not in made:
        made[width] = shingles(ws, width)
    return sum(x in made[width] for x in part) / len(part)


def indexes(items: DataFrame, share: float, width: int, index_bytes: int):
    """The indexes of blocks of items with about ``index_bytes`` of text each, one after the other. items: item_id, question,
    answer. Document frequencies, the mean length and the longest item are those of all items. A caller that lets go of
    an index before it asks for the next holds one at a time."""
    def split(batches):
        for b in batches:
            q, a = utf8(b.column(1)), utf8(b.column(2))
            rows = [(words(x), words(y)) for x, y in zip(q, a, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array([x for x, _ in rows], pa.list_(pa.binary())), pa.array([y for _, y in rows], pa.list_(pa.binary()))],
                ["item_id", "question", "answer"])

    kind = items.schema["item_id"].dataType.simpleString()
    items = items.select("item_id", "question", "answer").distinct()
    split_items = items.mapInArrow(split, f"item_id {kind}, question array<binary>, answer array<binary>")
    each = split_items.withColumn("words", F.concat("question", "answer")).filter(F.size("words") > 0)
    n, mean, longest, size = each.agg(F.count("*"), F.avg(F.size("words")), F.max(F.size("words")), F.sum(F.length(F.array_join(F.transform("words", lambda w: F.hex(w)), "")) / 2)).first()
    if not n:
        return
    blocks = int(size // index_bytes) + 1
    each = each.withColumn("block", F.pmod(F.xxhash64("question", "answer"), F.lit(blocks)))
    frequency = each.select(F.explode(F.array_distinct("words")).alias("word")).groupBy("word").agg(F.count("*").alias("df"))
    for k in range(blocks):
        mine = each.filter(F.col("block") == k)
        rows = [(r.item_id, [bytes(w) for w in r.question], [bytes(w) for w in r.answer]) for r in mine.select("item_id", "question", "answer").collect()]
        if rows:
            used = mine.select(F.explode("words").alias("word")).distinct()
            df = {bytes(r.word): r.df for r in frequency.join(used, "word", "left_semi").collect()}
            yield Index(sorted(rows, key=str), df, n, mean, longest, share, width), blocks


def contaminated(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", share: float = 0.8,
                 width: int = 5, index_bytes: int = 16 << 20) -> DataFrame:
    """One row for each row of ``docs`` and item found in it: id_col, item_id, score (BM25 of the passage), question_overlap,
    answer_overlap, first_word (of the passage). ``index_bytes`` sets how many blocks the items take, not what is found.

    items: item_id, question, answer. An item without words finds nothing; one without a question or an answer is judged by
    the other. Null and empty texts hold nothing. Rows with null or repeated ids are searched like others; repeated items
    count once; empty tables give no rows.
    """
    spark = docs.sparkSession
    spec = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    kind, item_kind = spec.schema["id"].dataType.simpleString(), items.schema["item_id"].dataType.simpleString()
    schema = f"id {kind}, item_id {item_kind}, score double, question_overlap double, answer_overlap double, first_word bigint"

    def searcher(index):
        def search(batches):
            for b in batches:
                rows, out = [], []
                for i, text in enumerate(utf8(b.column(1))):
                    for hit in index.value.hits(text):
                        rows.append(i)
                        out.append(hit)
                if out:
                    cols = list(zip(*out, strict=True))
                    yield pa.RecordBatch.from_arrays(
                        [b.column(0).take(pa.array(rows)), *(pa.array(c) for c in cols)],
                        ["id", "item_id", "score", "question_overlap", "answer_overlap", "first_word"])
        return search

    out = spark.createDataFrame([], schema)
    for index, blocks in indexes(items, share, width, index_bytes):
        shared = spark.sparkContext.broadcast(index)
        found = spec.mapInArrow(searcher(shared), schema)
        if blocks > 1:  # one index at a time
            found = materialise(found, "contaminated")
            shared.destroy()
        out = out.union(found)
    return out.withColumnRenamed("id", id_col)


def drop_contaminated(docs: DataFrame, items: DataFrame, text_col: str = "text", share: float = 0.8, width: int = 5,
                      index_bytes: int = 16 << 20) -> DataFrame:
    """The rows of ``docs`` in which no item is found, with all their columns. A row is judged by its own text."""
    at = docs.columns.index(text_col)

    def cleaner(index):
        def clean(batches):
            for b in batches:
                yield b.filter(pa.array([not index.value.hits(t) for t in utf8(b.column(at))], pa.bool_()))
        return clean

    schema = docs.schema
    for index, blocks in indexes(items, share, width, index_bytes):
        shared = docs.sparkSession.sparkContext.broadcast(index)
        docs = docs.mapInArrow(cleaner(shared), schema)
        if blocks > 1:
            docs = materialise(docs, "clean")
            shared.destroy()
    return docs


def question_and_answer(items: DataFrame, id_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """item_id, question, answer of items that are one text: the answer is the last line, or the last sentence of a text
    of one line, and the question what stands before."""
    whole = F.rtrim(F.coalesce(F.col(text_col), F.lit("")))
    answer = F.when(F.instr("whole", "\n") > 0, F.regexp_extract("whole", r"^[\s\S]*\n([^\n]*)$", 1)).otherwise(
        F.regexp_extract("whole", r"^[\s\S]*[.?!]\s+(\S[\s\S]*)$", 1))
    return items.select(F.col(id_col).alias("item_id"), whole.alias("whole")).withColumn("answer", answer).select(
        "item_id", F.expr("left(whole, length(whole) - length(answer))").alias("question"), "answer")
