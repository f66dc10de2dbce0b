"""Line dedup and the licence scan against plain Python versions."""

import re
from collections import Counter

import duckdb
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from survista.llm import licences, lines
from survista.llm.common import read


def brute_lines(rows, ratio, least):
    """rows: (id, host, text)."""
    pages, count = Counter(h for _, h, _ in rows), Counter()
    for _, h, t in rows:
        count.update((h, x) for x in set((t or "").split("\n")) if x and t is not None)
    gone = {k for k, n in count.items() if n >= least and n > ratio * pages[k[0]]}
    out = []
    for i, h, t in rows:
        every = [] if t is None else t.split("\n")
        kept = [x for x in every if (h, x) not in gone]
        out.append((i, h, None if t is None else "\n".join(kept), len(every), len(every) - len(kept)))
    return sorted(out, key=str)


def got_lines(df):
    return sorted((tuple(r) for r in df.select("doc_id", "source", "text", "a", "b").collect()), key=str)


def test_lines_of_the_table(spark, sf):
    docs = read(spark, sf, "documents")
    rows = [(r.doc_id, r.source, r.text) for r in docs.collect()]
    for ratio, least in ((0.01, 2), (0.2, 1)):
        assert got_lines(lines.drop_boilerplate(docs, ratio=ratio, min_pages=least, counts=("a", "b"))) == brute_lines(rows, ratio, least)


def test_line_edges(frame):
    menu = "Home | About"
    rows = [(i, f"{menu}\nunique {i}\n\n{menu}", "s") for i in range(6)] + [
        (10, None, "s"), (11, "", "s"), (12, menu, None), (12, menu, None), (None, menu + "\nx", None), (13, "\n\n", "t"), (14, "y\n" * 40_000, "t")]
    df = frame(rows).withColumnRenamed("lang", "line").withColumnRenamed("n_chars", "hash")
    want = brute_lines([(r[0], r[2], r[1]) for r in rows], 0.5, 2)
    out = lines.drop_boilerplate(df, ratio=0.5, min_pages=2, counts=("a", "b"))
    assert out.columns == [*df.columns, "a", "b"] and got_lines(out) == want
    assert lines.drop_boilerplate(frame([])).collect() == []


def test_line_sql(spark, sf):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{sf}/documents.parquet')")
    want = sorted(con.sql("SELECT doc_id, source, text, n_lines, n_dropped FROM (" + lines.SQL.format(ratio=0.01, min_pages=2) + ")").fetchall(), key=str)
    docs = read(spark, sf, "documents")
    assert got_lines(lines.drop_boilerplate(docs, ratio=0.01, min_pages=2, counts=("a", "b"))) == want


def test_copies_are_one_page(frame):
    prose = "One line of prose\nand another one"
    rows = [(i, prose, "s") for i in range(30)] + [(100 + i, f"Menu\nown words {i}", "s") for i in range(20)] + [
        (200 + i, prose, None) for i in range(8)] + [(300, None, "s"), (301, None, "s")]
    kept = {r.doc_id: r.text for r in lines.drop_boilerplate(frame(rows), ratio=0.2, min_pages=5, once=True).collect()}
    assert kept == {i: t if t is None or not t.startswith("Menu") else t.split("\n")[1] for i, t, _ in rows}
    pages = {(r.host, r.line, r.pages, r.host_pages) for r in lines.boilerplate(frame(rows), ratio=0.2, once=True).collect()}
    assert pages == {("s", "Menu", 20, 22)}


def brute_scan(text):
    w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    at = [(i, label) for p, label in licences.PHRASES.items() for i in range(len(w)) if w[i:i + len(p.split())] == p.split()]
    starts = [i for i, _ in at]
    return len(w), len(at), min(starts, default=None), max(starts, default=None), ",".join(sorted({x for _, x in at}))


def test_scan_of_the_table(spark, sf, frame):
    full = " ".join(licences.NOTICES["MIT"])
    rows = [(r.doc_id, r.text) for r in read(spark, sf, "documents").collect()]
    rows += [(None, None), (-1, ""), (-2, "MIT-License, cc by cc\nBY"), (-2, "MIT-License, cc by cc\nBY"), (-3, "the " * 60_000), (-4, full + " é " + full),
             (-5, "GNU general public; license")]
    got = {(r.doc_id, i): r for i, r in enumerate(sorted(licences.scan(frame(rows)).collect(), key=lambda r: str(r.doc_id)))}
    want = sorted(((i, *brute_scan(t)) for i, t in rows), key=lambda r: str(r[0]))
    assert [(r.doc_id, r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) for r in got.values()] == want
    for r in got.values():
        assert set(filter(None, r.base_labels.split(","))) <= set(r.labels.split(",")) and 0 <= r.score <= 1
        assert r.labels == ",".join(sorted(set(filter(None, r.labels.split(",")))))
    twice = next(r for r in got.values() if r.doc_id == -4)
    assert [s.notice for s in twice.spans] == ["MIT"] * 4 and twice.score == 1.0
    assert licences.scan(frame([])).collect() == []


@settings(deadline=None, max_examples=200)
@given(st.lists(st.lists(st.integers(0, 3), min_size=1, max_size=9), min_size=1, max_size=4), st.lists(st.integers(0, 4), max_size=20))
def test_matching_statistics(texts, seq):
    a = licences.Automaton(texts)
    for i, (n, s) in enumerate(a.statistics(seq)):
        places = lambda sub: {(k, e) for k, t in enumerate(texts) for e in range(len(t)) if t[:e + 1][-len(sub):] == sub and e + 1 >= len(sub)}
        best = max((m for m in range(i + 2) if m == 0 or places(seq[i - m + 1:i + 1])), default=0)
        assert n == best
        if n:
            assert a.ends[s] == places(seq[i - n + 1:i + 1])


@pytest.mark.parametrize("cut", [0, 1])
def test_chains_pass_over_changes(cut):
    text = licences.NOTICES["ISC"][0].split()
    text[9] = "xyzzy"
    del text[20:20 + cut]
    spans = licences.Scanner(licences.PHRASES, licences.NOTICES).scan(("before " * 5 + " ".join(text) + " after").encode())[2]
    assert [s[0] for s in spans] == ["ISC"] and 0.8 <= spans[0][3] < 1


def test_notice_that_another_one_goes_on_from():
    short, scanner = licences.NOTICES["Apache-2.0"][0], licences.Scanner(licences.PHRASES, licences.NOTICES)
    spans = scanner.scan(f"Code. {short} The software comes as it is.".encode())[2]
    assert spans == [("Apache-2.0", 1, 8, 1.0)]


def test_notice_inside_another_one():
    inner, outer = "b c d e f", "a b c d e f g h i j k l m n"
    spans = licences.Scanner({}, {"inner": [inner], "outer": [outer]}).scan(b"a b c d e f g")[2]
    assert spans == [("inner", 1, 5, 1.0)]


@settings(deadline=None, max_examples=200)
@given(st.lists(st.lists(st.sampled_from("abcd"), min_size=1, max_size=9), min_size=1, max_size=4), st.lists(st.sampled_from("abcde"), max_size=20))
def test_matches_are_those_that_their_template_does_not_go_on(texts, seq):
    scanner = licences.Scanner({}, {str(k): [" ".join(t)] for k, t in enumerate(texts)}, least=2)
    want = set()
    for k, t in enumerate(texts):
        for i in range(len(seq)):
            for j in range(len(t)):
                n = next((n for n in range(min(len(seq) - i, len(t) - j) + 1) if n == min(len(seq) - i, len(t) - j) or seq[i + n] != t[j + n]))
                if n >= 2 and (i == 0 or j == 0 or seq[i - 1] != t[j - 1]):
                    want.add((k, i, j, n))
    got = {}
    known = [scanner.ids.get(w.encode(), -1) for w in seq]
    edges = [i for i in range(len(seq) + 1) if i in (0, len(seq)) or known[i] < 0 or known[i - 1] < 0]
    for a, z in zip(edges, edges[1:]):
        if known[a] >= 0:
            scanner._long(known[a:z], a, got)
    assert sorted((k, *m) for k, ms in got.items() for m in ms) == sorted(want)
