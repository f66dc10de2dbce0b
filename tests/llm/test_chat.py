"""Preference pairs against a plain version."""

import numpy as np
import public_tokenizers

from survista.llm import chat
from survista.llm.catalog import preference_turns
from survista.llm.common import read
from survista.llm.tokens import Encoder

BYTE = public_tokenizers.path("byte_bpe_50k.json")


def brute(chosen, rejected):
    """Turns (pair, turn, role, text) to (pair, prompt, chosen, rejected) of one block."""
    enc = Encoder(BYTE, True)
    sides = []
    for rows in (chosen, rejected):
        side = {}
        for p, n, role, text in rows:
            side.setdefault(p, {}).setdefault(n, []).append((role or "", text or ""))
        sides.append({p: {n: sorted(x) for n, x in t.items()} for p, t in side.items()})
    order = lambda n: (n is not None, n or 0)

    def part(turns, learn):
        text, ids, mask = "", [], []
        for role, said in turns:
            for piece, on in ((f"<|{role}|>\n", 0), (said + "\n", int(learn and role == "assistant"))):
                new = np.frombuffer(enc.encode(piece.encode()), "<u4").tolist()
                text, ids, mask = text + piece, ids + new, mask + [on] * len(new)
        return text, ids, mask
    out = []
    for p in {*sides[0], *sides[1]}:
        a, b = sides[0].get(p, {}), sides[1].get(p, {})
        prompt = []
        for n in sorted({*a, *b}, key=order):
            if a.get(n) != b.get(n):
                break
            prompt.append(n)
        rest = [[x for n in sorted(s, key=order) if n not in prompt for x in s[n]] for s in (a, b)]
        out.append((p, *part([x for n in prompt for x in a[n]], False)[:2], *part(rest[0], True), *part(rest[1], True)))
    return sorted(out, key=lambda r: str(r[0]))


def got(df):
    return sorted(((r.pair_id, r.prompt, r.prompt_ids, r.chosen, r.chosen_ids, r.chosen_mask, r.rejected, r.rejected_ids, r.rejected_mask)
                   for r in df.collect()), key=lambda r: str(r[0]))


def turns(df):
    return [(r.pair_id, r.turn, r.role, r.text) for r in df.collect()]


def test_whole_table(spark, sf):
    a, b = preference_turns(read(spark, sf, "conversations"))
    want = brute(turns(a), turns(b))
    assert any(r[1] and r[3] and r[6] for r in want)
    assert got(chat.preference_pairs(a, b, BYTE)) == want


def test_edge_rows(spark):
    schema = "pair_id bigint, turn bigint, role string, text string"
    a = [(1, 0, "user", "q"), (1, 1, "assistant", "a"), (2, 0, "user", "same"), (3, 0, None, None), (3, 1, "assistant", ""), (4, None, "system", "s"),
         (4, 0, "user", "x"), (5, 2, "user", "twice"), (5, 2, "user", "twice"), (5, 2, "assistant", "tie"), (None, 0, "user", "no id"), (7, 0, "assistant", "w " * 30_000),
         (8, 5, "user", "only here")]
    b = [(1, 0, "user", "q"), (1, 1, "assistant", "b"), (1, 2, "user", "more"), (2, 0, "user", "same"), (3, 0, "", ""), (3, 1, "assistant", "z"),
         (4, None, "system", "s"), (4, 0, "user", "y"), (5, 2, "assistant", "tie"), (5, 2, "user", "twice"), (None, 0, "user", "other"), (9, 0, "user", "only there")]
    fa, fb = spark.createDataFrame(a, schema), spark.createDataFrame(b, schema)
    assert got(chat.preference_pairs(fa, fb, BYTE)) == brute(a, b)
    assert got(chat.preference_pairs(fa.filter("false"), fb.filter("false"), BYTE)) == []


def test_long_conversations(spark):
    """One row a pair; its parts where the caller asks for them."""
    rows = [(1, n, "assistant" if n % 2 else "user", f"turn {n}") for n in range(3000)]
    other = rows[:1500] + [(1, n, role, text + " else") for _, n, role, text in rows[1500:]]
    schema = "pair_id bigint, turn bigint, role string, text string"
    a, b = spark.createDataFrame(rows, schema), spark.createDataFrame(other, schema)
    assert got(chat.preference_pairs(a, b, BYTE)) == brute(rows, other)
    out = chat.preference_pairs(a, b, BYTE, block_turns=1024).orderBy("block").collect()
    want = brute(rows, other)[0]
    assert [r.block for r in out] == [0, 1, 2]
    for k, name in enumerate(("prompt", "prompt_ids", "chosen", "chosen_ids", "chosen_mask", "rejected", "rejected_ids", "rejected_mask"), 1):
        whole = type(want[k])()
        for r in out:
            whole += r[name]
        assert whole == want[k]


def test_pair_ids_of_other_types(spark):
    for kind, ids in (("string", ["x", "0", "", None]), ("decimal(20,2)", ["1.50", "2.00", None]), ("date", ["2020-01-02", None])):
        a = spark.createDataFrame([(i, 0, "user", "q") for i in ids] + [(i, 1, "assistant", "a") for i in ids], "pair_id string, turn int, role string, text string")
        b = spark.createDataFrame([(i, 0, "user", "q") for i in ids] + [(i, 1, "assistant", "b") for i in ids], "pair_id string, turn int, role string, text string")
        a, b = (f.withColumn("pair_id", f.pair_id.cast(kind)) for f in (a, b))
        out = chat.preference_pairs(a, b, BYTE)
        assert out.schema["pair_id"].dataType == a.schema["pair_id"].dataType
        assert sorted((str(r.pair_id), r.prompt, r.chosen) for r in out.collect()) == sorted((str(i), "<|user|>\nq\n", "<|assistant|>\na\n") for i in ids)
