"""Token ids, best-fit packing and range-coded id files."""

import random
import zlib
from functools import lru_cache

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from survista.llm import idfile, packing, range_coder
from survista.llm.common import read
from survista.llm.tokens import Encoder

WORD, BYTE = public_tokenizers.path("word_bpe_49k.json"), public_tokenizers.path("byte_bpe_50k.json")
KINDS = [(WORD, False), (BYTE, True)]
EDGE = [None, "", " ", "\n", "\n\n", " a", "a ", "a  b", "a\n\nb", "a \n b", "a\tb\r\nc", "it's I'll don'T 'tis", "x y z", "a  b",
        "́a ́b é", "naïve «Été» Σας ΣΑΣ İstanbul", "<|endoftext|> <|startoftext|>a", "3.14 1,000 $5!!! ### a.b,c", "\x1c \x1f\x85 q",
        "a<|endoftext|>b. <|ENDOFTEXT|>, x", " <|startoftext|> <|endoftext|>\n", "<|endoftext", "<|ok|> <| endoftext|>", "日本語 テスト", "word," * 3, "A.***", "é, à! ×, ÷.", "'s 't ' s", "a\x00b \x00", "a\x0b b\x0c"]


@lru_cache
def tokenizer(path):
    return Tokenizer.from_file(path)


def whole(path, text):
    return tokenizer(path).encode(text or "", add_special_tokens=False).ids


@pytest.fixture(scope="module", params=KINDS, ids=["word", "byte"])
def both(request):
    path, kind = request.param
    return Encoder(path, kind, room=50), tokenizer(path)


@settings(deadline=None, max_examples=400)
@given(st.text(alphabet=st.sampled_from(list("abZ .,'!\n\t  0éÉÑß×  ́Σ日\r\x1c")), max_size=30) | st.text(max_size=30))
def test_ids_are_those_of_the_whole_text(both, text):
    encoder, t = both
    assert np.frombuffer(encoder.encode(text.encode()), "<u4").tolist() == t.encode(text, add_special_tokens=False).ids


def test_ids_of_documents(spark, sf, both):
    encoder, t = both
    for r in read(spark, sf, "documents").limit(60).collect() + [type("R", (), {"text": x or ""}) for x in EDGE]:
        assert np.frombuffer(encoder.encode(r.text.encode()), "<u4").tolist() == t.encode(r.text, add_special_tokens=False).ids


@pytest.mark.parametrize("n", [0, 1, 2, 127, 128, 129, 4000, 70_000])
def test_blocks_round_trip(n):
    r = np.random.default_rng(n)
    for top in (1, 3, 49_408):
        ids = r.integers(0, top, n).astype(np.uint32)
        ids[n // 2:] = ids[:n - n // 2]  # repeats
        assert (range_coder.decode(range_coder.encode(ids)) == ids).all()


def test_full_lanes_round_trip():
    r = np.random.default_rng(1)
    ids = (r.zipf(1.2, range_coder.LANES * 129 + 7) % 49_408).astype(np.uint32)
    assert (range_coder.decode(range_coder.encode(ids)) == ids).all()


@pytest.mark.parametrize("size", [1, 2, 300, 49_408])
def test_find_is_a_search_of_the_running_counts(size):
    r = np.random.default_rng(size)
    for most in (1, 5, 100_000):
        model = range_coder._Model(size)
        model.cum[1:] = np.cumsum(r.integers(1, most + 1, size) ** r.integers(1, 3, size))
        total = int(model.cum[-1])
        v = np.concatenate((r.integers(0, total, 5000), [0, total - 1], model.cum[:-1], model.cum[1:] - 1))
        assert (model.find(v) == np.searchsorted(model.cum, v, side="right") - 1).all()


def test_damage_is_found():
    block = bytearray(range_coder.encode(np.arange(500, dtype=np.uint32)))
    for i in (0, 5, 20, len(block) - 1):
        bad = bytearray(block)
        bad[i] ^= 1
        with pytest.raises(ValueError):
            range_coder.decode(bytes(bad))


def test_predictable_ids_take_less_room():
    ids = np.tile(np.arange(50, dtype=np.uint32), 400)
    assert len(range_coder.encode(ids)) < len(ids) / 2


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


def file_rows(rows):
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or ""))
    out, start = [], 0
    for i, t in rows:
        ids = whole(WORD, t) + [1]
        out.append((i, start, len(ids), crc(ids)))
        start += len(ids)
    return out


def test_files_round_trip(spark, sf, frame):
    docs = read(spark, sf, "documents")
    got = idfile.round_trip(docs, WORD).orderBy("start").collect()
    assert [tuple(r) for r in got] == file_rows([(r.doc_id, r.text) for r in docs.collect()])
    rows = [(i if i % 7 else None, t) for i, t in enumerate(EDGE)] + [(3, "twice"), (3, "twice"), (50, "long " * 50_000)]
    path_rows = [tuple(r) for r in idfile.round_trip(frame(rows), WORD).orderBy("start").collect()]
    assert path_rows == file_rows(rows)
    assert idfile.round_trip(frame([]), WORD).count() == 0


def test_many_blocks(spark, frame, tmp_path):
    rows = [(i, f"some words {i} " * (i % 40)) for i in range(300)]
    path = str(tmp_path / "ids")
    idfile.write(frame(rows), path, WORD, block_ids=100)
    assert spark.read.parquet(path).count() > 50
    assert [tuple(r) for r in idfile.read(spark, path).orderBy("start").collect()] == file_rows(rows)


def check_packing(rows, got, size, max_documents=10**9, max_attention=10**12):
    want = []
    for i, t in rows:
        ids = whole(BYTE, t) + [2]
        n, k = len(ids), -(-len(ids) // size)
        first = n - size * (k - 1)
        for p in range(k):
            a = 0 if p == 0 else first + size * (p - 1)
            z = first + size * p
            want.append((i, p, a, z - a, crc(ids[a:z])))
    key = lambda r: tuple(map(str, r))
    assert sorted((tuple(r)[:5] for r in got), key=key) == sorted(want, key=key)
    bins = {}
    for r in got:
        bins.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for b in bins.values():
        if len(b) == 1 and b[0][1] ** 2 > max_attention:  # alone, as no sequence has room for it
            assert b[0][0] == 0
            continue
        at = 0
        for offset, length in sorted(b):
            assert offset == at
            at += length
        assert at <= size and len(b) <= max_documents and sum(n * n for _, n in b) <= max_attention
    return len(bins), sum(r[3] for r in want)


def test_packing(spark, sf, frame):
    docs = read(spark, sf, "documents")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    n, total = check_packing(rows, packing.pack(docs, BYTE, 2).collect(), 1024)
    assert n <= total / 1024 * 1.05 + 1
    rows = [(i if i % 5 else None, t) for i, t in enumerate(EDGE)] + [(2, "again"), (2, "again"), (77, "long words here " * 9000)]
    check_packing(rows, packing.pack(frame(rows), BYTE, 2, size=64, max_documents=3, max_attention=64 * 64).collect(), 64, 3, 64 * 64)
    check_packing(rows, packing.pack(frame(rows), BYTE, 2, size=64, shard_pieces=5).collect(), 64)
    few, _ = check_packing(rows, packing.pack(frame(rows), BYTE, 2, size=64).collect(), 64)
    many, _ = check_packing(rows, packing.pack(frame(rows), BYTE, 2, size=64, max_attention=150).collect(), 64, max_attention=150)
    assert many > few  # attention cost decides
    assert packing.pack(frame([]), BYTE, 2).collect() == []


@pytest.mark.parametrize("fit", [packing.fit_by_norm, packing.fit_by_dot])
@pytest.mark.parametrize("docs,attention", [(1000, 10**4), (4, 10**4), (1000, 5000)])
def test_fits_keep_every_capacity(fit, docs, attention):
    r = random.Random(docs)
    lengths = np.array([r.randint(1, 70) for _ in range(3000)])
    bins = fit(lengths, np.array([100, docs, attention], float), np.array([1.0, 0.05, 0.05]))
    tokens, count, cost = (np.bincount(bins, x) for x in (lengths, np.ones_like(lengths), lengths * lengths))
    assert tokens.max() <= 100 and count.max() <= docs and cost.max() <= attention and count.min() >= 1
    if docs > 100 and attention == 10**4:
        assert len(tokens) <= lengths.sum() / 100 * 1.02 + 1
