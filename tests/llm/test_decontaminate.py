"""Retrieval and overlap against a version that compares every item with every passage."""

import random
import re
from math import log

import pytest

from survista.llm import decontaminate
from survista.llm.common import read
from survista.llm.licences import words


def item_words(text):
    t = (text or "").rstrip(" ")
    if "\n" in t:
        i = t.rindex("\n") + 1
    else:
        m = re.match(r"^[\s\S]*[.?!]\s+(?=\S)", t)
        i = m.end() if m else len(t)
    return words(t[:i].encode()), words(t[i:].encode())


def runs(ws, width=5):
    return {tuple(ws[i:i + width]) for i in range(max(1, len(ws) - width + 1))} if ws else set()


def brute(docs, items, share=0.8):
    items = [(i, *item_words(t)) for i, t in items]
    items = [x for x in items if x[1] + x[2]]
    half = max((len(q) + len(a) for _, q, a in items), default=1)
    n, mean = len(items), sum(len(q + a) for _, q, a in items) / max(1, len(items))
    df = {}
    for _, q, a in items:
        for w in set(q + a):
            df[w] = df.get(w, 0) + 1
    out = []
    for d, t in docs:
        ws = words((t or "").encode())
        best = {}
        for p in range(0, max(1, len(ws)), half):
            there = ws[p:p + 2 * half]
            for k, (_, q, a) in enumerate(items):
                found = []
                for part in (q, a, q + a):
                    s = runs(part)
                    w = len(next(iter(s))) if s else 0
                    found.append(sum(x in runs(there, w) for x in s) / len(s) if s else 1.0)
                whole = found.pop()
                if (min(found) >= share or whole >= share) and there and (k not in best or sum(found) > sum(best[k][1:3])):
                    ws_k, score = q + a, 0.0
                    for w in set(ws_k) & set(there):
                        f = ws_k.count(w)
                        score += log(1 + (n - df[w] + 0.5) / (df[w] + 0.5)) * f * 2.2 / (f + 1.2 * (0.25 + 0.75 * len(ws_k) / mean))
                    best[k] = (round(score, 6), *found, p)
        out += [(d, items[k][0], *v) for k, v in best.items()]
    return sorted(out, key=str)


def got(df):
    return sorted(((r.doc_id, r.item_id, round(r.score, 6), r.question_overlap, r.answer_overlap, r.first_word) for r in df.collect()), key=str)


@pytest.fixture
def items_of(spark):
    def make(rows):
        return decontaminate.question_and_answer(spark.createDataFrame(rows, "item_id bigint, text string"))
    return make


def edited(r, text):
    """The text among others, some of its words changed."""
    ws = text.split(" ")
    for _ in range(r.choice([0, 0, 1, 2, 4, 8])):
        ws[r.randrange(len(ws))] = r.choice(["the", "zzz", "of"])
    return " ".join(ws)


def test_against_all_pairs(spark, sf, frame, items_of):
    r = random.Random(5)
    items = [(x.item_id, x.text) for x in read(spark, sf, "benchmark").collect()]
    docs = [(x.doc_id, x.text) for x in read(spark, sf, "documents").limit(60).collect()]
    docs += [(1000 + k, f"{r.choice(docs)[1][:r.randrange(900)]} {edited(r, r.choice(items)[1])} {r.choice(docs)[1][:r.randrange(900)]}") for k in range(80)]
    want = brute(docs, items)
    assert len(want) > 30
    assert got(decontaminate.contaminated(frame(docs), items_of(items))) == want
    for size in (6000, 15_000):
        assert got(decontaminate.contaminated(frame(docs), items_of(items), index_bytes=size)) == want
    clean = decontaminate.drop_contaminated(frame(docs), items_of(items), index_bytes=12_000)
    assert clean.columns == frame(docs).columns
    assert sorted(x.doc_id for x in clean.collect()) == sorted({i for i, _ in docs} - {x[0] for x in want})


def test_edge_rows(frame, items_of):
    items = [(1, "What is two and two? Four."), (1, "What is two and two? Four."), (2, None), (3, ""), (4, "..."), (None, "One line only"),
             (5, "alpha beta\ngamma"), (6, "rep rep rep rep rep rep rep rep rep. rep rep rep")]
    docs = [(1, "what IS two, and two? four!"), (2, None), (3, ""), (None, "so one line only here"), (4, "x " * 40_000 + "alpha beta gamma"),
            (4, "x " * 40_000 + "alpha beta gamma"), (5, "What is two and two? Five."), (6, "rep " * 30)]
    unique = list(dict.fromkeys(items))
    assert got(decontaminate.contaminated(frame(docs), items_of(items))) == brute(docs, unique)
    assert got(decontaminate.contaminated(frame([]), items_of(items))) == []
    assert got(decontaminate.contaminated(frame(docs), items_of([]))) == []
    assert decontaminate.drop_contaminated(frame(docs), items_of([(2, None)])).count() == len(docs)


def test_question_and_answer(items_of):
    got = {r.item_id: (r.question, r.answer) for r in items_of([(1, "A b. C d? E"), (2, "a\nb\nc d"), (3, "whole"), (4, None), (5, "Only one.")]).collect()}
    assert got == {1: ("A b. C d? ", "E"), 2: ("a\nb\n", "c d"), 3: ("whole", ""), 4: ("", ""), 5: ("Only one.", "")}


def test_wand_finds_all_above_the_threshold():
    r = random.Random(9)
    vocabulary = [f"w{i}".encode() for i in range(60)]
    items = [(k, [r.choice(vocabulary) for _ in range(r.randint(2, 9))], [r.choice(vocabulary)]) for k in range(90)]
    df = {w: sum(w in q + a for _, q, a in items) for w in vocabulary}
    ix = decontaminate.Index(items, df, len(items), 6.0, 10, 0.8, 5)
    for _ in range(300):
        terms = sorted({ix.ids[w] for w in r.sample(vocabulary, r.randint(1, 30)) if w in ix.ids})
        sums = {}
        for t in terms:
            for j in range(ix.first[t], ix.first[t + 1]):
                sums[int(ix.item[j])] = sums.get(int(ix.item[j]), 0.0) + ix.impact[j]
        sure = {k for k, s in sums.items() if s > 1 + 1e-9}
        found = {k for k, _ in ix.wand(terms)}
        assert sure <= found <= {k for k, s in sums.items() if s > 1 - 1e-9}


def test_parts_that_stand_apart_and_short_answers(spark, frame):
    """Question and answer 60 words apart are found beside a long item, whatever block it is in; a changed word in a short
    answer does not hide an item of which nine tenths stand there."""
    q, a = " ".join(f"ask{k}" for k in range(12)), " ".join(f"tell{k}" for k in range(9))
    long = " ".join(f"other{k}" for k in range(400))
    short = " ".join(f"word{k}" for k in range(40))
    items = spark.createDataFrame([(1, q, a), (2, long, ""), (3, short, "yes it is")], "item_id bigint, question string, answer string")
    apart = q + " " + " ".join(f"gap{k}" for k in range(60)) + " " + a
    docs = frame([(10, apart), (11, short + " yes it was"), (12, q + " nothing else"), (13, " ".join(short.split()[:25]))])
    for size in (1500, 1 << 20):
        found = decontaminate.contaminated(docs, items, index_bytes=size).select("doc_id", "item_id").collect()
        assert sorted(map(tuple, found)) == [(10, 1), (11, 3)]
        assert sorted(r.doc_id for r in decontaminate.drop_contaminated(docs, items, index_bytes=size).collect()) == [12, 13]
