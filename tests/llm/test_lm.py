"""Scores against a dictionary model with the same quantised counts, and the filter's own promises."""

import re
from collections import Counter
from math import log10

import numpy as np
import pandas as pd
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from survista.llm import lm
from survista.llm.common import read


def toks(text):
    return re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")) + [None]


def brute(rows, base=1.5, strength=64.0):
    """rows: (id, text, learn)."""
    one, two = Counter(), Counter()
    for _, t, flag in rows:
        if flag:
            w = toks(t)
            one.update(w)
            two.update(zip([None, *w], w, strict=False))
    n, v = sum(one.values()), len(one)
    value = lm.LogFrequencyBloom.estimates(base)

    def est(c):
        return float(value[lm.LogFrequencyBloom.levels_of(np.array([c]), base)[0]])
    out = []
    for i, t, _ in rows:
        w = toks(t)
        s = 0.0
        for u, x in zip([None, *w], w, strict=False):
            cu = est(one[u])
            s += log10((min(est(two[u, x]), cu) + strength * (est(one[x]) + 1) / (n + v + 1)) / (cu + strength))
        out.append((i, len(w), sum(one[x] > 0 for x in w), n, sum(log10((one[x] + 1) / (n + v + 1)) for x in w), s))
    return out


def compare(got, want):
    got, want = (sorted(x, key=lambda r: (str(r[0]), r[1], r[5])) for x in (map(tuple, got), want))
    assert [g[:4] for g in got] == [w[:4] for w in want]
    assert np.allclose([g[4:] for g in got], [w[4:] for w in want], rtol=1e-9)


def fold():
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")), F.lit(0)) % 7 != 2


def rows_of(df):
    return [(r.doc_id, r.text, r.flag) for r in df.select("doc_id", "text", fold().alias("flag")).collect()]


def test_whole_table_both_ways(spark, sf):
    docs = read(spark, sf, "documents")
    want = brute(rows_of(docs))
    compare(lm.score(docs, fold(), hashes=30, chunk_tokens=5000, shard_tokens=4000).collect(), want)
    compare(lm.score(docs, fold(), hashes=30, chunk_tokens=20_000, shard_tokens=30_000, broadcast_bytes=0).collect(), want)


def test_few_hashes_raise_counts_only_seldom(spark, sf):
    docs = read(spark, sf, "documents")
    want = {r[0]: r[5] for r in brute(rows_of(docs))}
    got = {r.doc_id: r.score for r in lm.score(docs, fold()).collect()}
    assert sum(abs(got[i] - s) for i, s in want.items()) < 0.01 * sum(abs(s) for s in want.values())


def test_edge_rows(frame):
    rows = [(None, "A b"), (1, None), (2, ""), (3, " \n"), (4, "a B a b"), (4, "a B a b"), (5, "é É \x85x"), (6, "w " * 50_000), (7, "unseen zzz")]
    df = frame(rows)
    compare(lm.score(df, fold(), hashes=30, chunk_tokens=3).collect(), brute(rows_of(df)))
    assert lm.score(frame([]), fold()).collect() == []
    nothing = lm.score(df, F.lit(False)).collect()
    assert all(r.train_tokens == 0 and r.n_known == 0 and r.base_score == 0 for r in nothing)


@pytest.mark.parametrize("base", [1.2, 1.5, 2.0])
def test_filter_holds_its_levels(base):
    r = np.random.default_rng(3)
    keys = np.unique(r.integers(0, 2**63, 20_000).astype(np.uint64))
    counts = (r.pareto(1, len(keys)) + 1).astype(np.int64)
    f = lm.LogFrequencyBloom.of(keys, counts, 6, base)
    level, got = f.levels_of(counts, base), f.lookup(keys)
    assert (got >= level).all() and (got > level).mean() < 0.03
    assert (f.lookup(r.integers(0, 2**63, 20_000).astype(np.uint64)) > 0).mean() < 0.03
    low, high = f.edges(base)[:-1], f.edges(base)[1:] - 1
    assert ((f.estimates(base)[1:-1] >= low) & (f.estimates(base)[1:-1] <= high)).all()


def test_tokens_as_bytes_split():
    texts = [None, "", " ", "\n\t", "a", " A  b ", "a\x0bB\x0cc\rd", "x\x1cy\x85z\u00a0\u2003é É", "\x00 \x1f", "end\n"]
    for kind in (pa.string(), pa.large_string()):
        got = [[w.encode() for w in x] for x in lm.token_lists(pa.array(texts, kind)).to_pylist()]
        assert got == [[*(t or "").encode().lower().split(), b""] for t in texts]


@pytest.mark.parametrize("bits", [0, 3, 9])
def test_packed_routes_come_back(bits):
    r = np.random.default_rng(bits)
    near = r.integers(0, 2**20, 5000).astype(np.uint64)
    far = r.integers(0, 2**48, 3000).astype(np.uint64)
    keys = np.unique(np.concatenate([near, far, np.array([0, 2**48 - 1, 2**32 - 1, 2**33 - 1], np.uint64)]))
    spans = [(a, z) for _, a, z in lm._shards(keys, bits, 2)]
    back, ends = lm.unpacked(lm.packed(keys, spans))
    assert (back == keys).all() and ends.tolist() == [z for _, z in spans]
    some = lm.packed(keys, spans)[::2]
    assert (lm.unpacked(some)[0] == np.concatenate([keys[a:z] for a, z in spans[::2]])).all()
    counts = r.choice([0, 1, 255, 256, 65535, 65536, 2**32 - 1, 2**32, 2**40], len(keys))
    assert (lm._widened(lm._narrow(counts, spans)) == counts).all()


def test_a_shard_probes_a_key_once_for_all_chunks(monkeypatch):
    """Work of a shard must not grow with the number of chunks that have a key, else it goes with the square of the corpus."""
    r = np.random.default_rng(5)
    known = np.unique(r.integers(0, 2**48, 2000).astype(np.uint64))
    chunks = [np.sort(r.choice(known, 900, replace=False)) for _ in range(200)]
    seen = [r.integers(0, 4, 900) for _ in chunks]
    rows = pd.DataFrame({"shard": 0, "chunk": range(200), "keys": [lm.packed(k, [(0, 900)])[0] for k in chunks],
                         "counts": [lm._narrow(c, [(0, 900)])[0] for c in seen]})
    probed, lookup = [], lm.LogFrequencyBloom.lookup
    monkeypatch.setattr(lm.LogFrequencyBloom, "lookup", lambda self, keys: probed.append(len(keys)) or lookup(self, keys))
    out = lm.count_shard((0,), rows, 2, 30, 1.5)
    assert sum(probed) == len(known)
    total = Counter()
    for k, c in zip(chunks, seen, strict=True):
        total.update(dict(zip(k.tolist(), c.tolist(), strict=True)))
    level = {k: int(lm.LogFrequencyBloom.levels_of(np.array([c]), 1.5)[0]) if c else 0 for k, c in total.items()}
    got = out[out["chunk"].notna()].sort_values("chunk")["levels"]
    assert [list(x) for x in got] == [[level[i] for i in k.tolist()] for k in chunks]
    whole = out[out["chunk"].isna()].iloc[0]
    assert whole["total"] == sum(total.values()) and whole["distinct"] == sum(c > 0 for c in total.values())


@pytest.mark.parametrize("size", [0, 1 << 30])
def test_chunks_are_not_exchanged(spark, frame, size):
    out = lm.score(frame([(i, f"a b{i} c") for i in range(50)]), fold(), chunk_tokens=20, broadcast_bytes=size)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning(chunk") == 1 and "Bucketed: true" in plan
    assert not [t for t in spark.catalog.listTables() if t.name.startswith("survista_")]
    assert out.count() == 50
