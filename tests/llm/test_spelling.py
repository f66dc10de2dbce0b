"""Spelling variants against a plain version."""

import re
import zlib
from collections import Counter

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from survista.llm import spelling
from survista.llm.catalog import QUERIES
from survista.llm.common import read

_LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > 1 or a == b:
        return False
    i = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), len(a))  # noqa: B905
    return a[i:] == b[i + 1:] if len(a) < len(b) else a[i + 1:] == b[i + 1:]


def brute(rows, drop=97):
    counts = Counter()
    for doc, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(_LOWER)
            h = zlib.crc32(f"{'' if doc is None else doc}:{run}".encode())
            if h % drop == 0:
                k = h % len(run)
                run = run[:k] + run[k + 1:]
            counts[run] += 1
    words = {w: n for w, n in counts.items() if len(w) >= 5 and n >= 3}
    form, near = {}, {}
    for w, n in words.items():
        around = [x for x in words if abs(len(x) - len(w)) < 2 and one_edit(w, x)]
        best = min(around, key=lambda x: (-words[x], x), default=None)
        near[w], form[w] = len(around), best if best and words[best] >= 2 * n else None
    out = []
    for w, n in words.items():
        root = w
        while form[root]:
            root = form[root]
        out.append((w, form[w], root, n, near[w], words[form[w]] if form[w] else None))
    return sorted(out)


def got(df):
    return sorted(tuple(r) for r in df.select("word", "form", "root", "n", "n_near", "form_n").collect())


def test_whole_table(spark, sf):
    want = brute([(r.doc_id, r.text) for r in read(spark, sf, "documents").collect()])
    assert sum(r[1] is not None for r in want) > 5
    assert got(QUERIES["op13_spelling"](spark, sf)) == want


def test_many_shards_and_passes(spark, sf):
    docs = read(spark, sf, "documents")
    want = brute([(r.doc_id, r.text) for r in docs.collect()], drop=5)
    assert any(r[1] and r[1] != r[2] for r in want)  # a chain
    for sizes in ({"part_words": 200, "broadcast_bytes": 1}, {"part_words": 50, "broadcast_bytes": 900}, {"bits": 1}):
        assert got(spelling.spelling_forms(docs, drop=5, **sizes)) == want


def test_edge_rows(frame):
    rows = [(1, None), (2, ""), (None, "Hello hello hELLo jello jello jello jello jello jello"), (3, "hellö hellö hellö ÉCOLE École École ecole"),
            (4, "aabbb " * 3 + "abbb " * 9 + "aabbbb " * 3 + "aaabbb " * 7), (4, "aabbb " * 3), (5, "x" * 3000 + " " + "×÷×÷× " * 3 + "中abcde" * 4),
            (6, ("y" * 3000 + " ") * 4 + ("y" * 3001 + " ") * 8 + ("y" * 2000 + "z" + "y" * 999 + " ") * 16)]
    df = frame(rows).selectExpr("*", "1 AS word", "2 AS n", "3 AS form")
    assert got(spelling.spelling_forms(df)) == brute(rows)
    assert got(spelling.spelling_forms(frame([]))) == []
    assert got(spelling.spelling_forms(frame([(1, "few of them")]))) == []


@settings(deadline=None, max_examples=60)
@given(st.lists(st.text("abé", min_size=5, max_size=8), min_size=1, max_size=30, unique=True))
def test_edits_reach_each_pair_once(words):
    alphabet = np.array(sorted({ord(c) for w in words for c in w}), np.uint64)
    filters, found = {}, Counter()
    by_length = {}
    for w in words:
        by_length.setdefault(len(w), []).append(w.encode("latin-1"))
    for k, ws in by_length.items():
        keys = spelling.mixed(spelling.hashes(spelling.letters(ws)))
        part = spelling.BlockedBloom.part_of(keys, np.uint64(3))
        filters[k] = spelling.BlockedBloom(np.concatenate([spelling.BlockedBloom.built(keys[part == p], 2) for p in range(3)]), 2, 3)
    for ws in by_length.values():
        for i, edit in spelling.candidates(ws, filters, alphabet, 5):
            assert one_edit(ws[i].decode("latin-1"), edit.decode("latin-1"))
            if edit in by_length.get(len(edit), ()):
                found[frozenset((ws[i], edit))] += 1
    want = {frozenset((a.encode("latin-1"), b.encode("latin-1"))) for a in words for b in words if one_edit(a, b)}
    assert found == Counter(want)
