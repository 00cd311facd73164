"""Packing: whole coverage, no gaps, few sequences, and ids as the tokenizer gives them."""

import random
import zlib
from collections import Counter, defaultdict

import numpy as np
from tokenizers import Tokenizer

from tallyloom.llm import packing
from tallyloom.llm.queries import tokenizer_path


def ids_of(tok, text):
    return np.array([*tok.encode(text or "", add_special_tokens=False).ids, 1], "<u4")


def holds(df, capacity, **kw):
    rows = df.select("doc_id", "text").collect()
    packed = packing.pack(df, tokenizer_path(), capacity, **kw).collect()
    tok = Tokenizer.from_file(tokenizer_path())
    want = Counter()
    for r in rows:
        ids = ids_of(tok, r["text"])
        for n, at in enumerate(range(0, len(ids), capacity)):
            part = ids[at : at + capacity]
            want[r["doc_id"], n, at, len(part), zlib.crc32(part.tobytes())] += 1
    assert Counter((p["doc_id"], p["piece"], p["start"], p["length"], p["ids_crc32"]) for p in packed) == want
    by = defaultdict(list)
    for p in packed:
        by[p["sequence_id"]].append((p["offset"], p["length"]))
    for parts in by.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity
    return len(by), sum(p["length"] for p in packed)


def test_table(spark):
    n, total = holds(spark.read.parquet("/root/testdata/sf0.01/documents.parquet"), 4096)
    assert n <= 1.01 * total / 4096 + 1


def test_odd_texts(spark):
    texts = [None, "", " ", "a\x1cb\x1dc", "<|endoftext|> x<|startoftext|>y", "É é ﬁ İSTANBUL ΣΑΣ", "日本語" * 40, "it's we'll 123 $$$%%", "　a b́", "Same, same. ÉTÉ! Σάς, ΟΔΟΣ. İi; d. 's. l'été, x,y ... ,, ǅ. ﬁ! e\u0301. ά", "same", "same", "word " * 500,
             "<|EndOfText|>, <|endoftext|>. x", "a_, b_c. d%%% e... f!? g'' h's. ²! ½, x́, a\u00a0b, c\u2028d; ÀÉ... 3, _. l'. Don'T. 'S!", "A.B.C. e.g., (x) [Y]; {z}~ `q` a-b- --c"]
    rows = [(None if i == 3 else i // 2, t) for i, t in enumerate(texts)]
    holds(spark.createDataFrame(rows, "doc_id long, text string"), 16)
    assert packing.pack(spark.createDataFrame([], "doc_id long, text string"), tokenizer_path()).count() == 0


def test_sequences_hold_the_ids(spark):
    df = spark.createDataFrame([(1, "one two three"), (2, "four")], "doc_id long, text string")
    seq = packing.sequences(packing.pack(df, tokenizer_path(), 64, keep_ids=True)).collect()
    tok = Tokenizer.from_file(tokenizer_path())
    assert len(seq) == 1 and bytes(seq[0]["ids"]) == ids_of(tok, "one two three").tobytes() + ids_of(tok, "four").tobytes()


def test_plan_equals_best_fit():
    rnd = random.Random(5)
    for _ in range(40):
        cap = rnd.randint(3, 60)
        counts = Counter(rnd.randint(1, cap) for _ in range(rnd.randint(1, 200)))
        plan = packing.plan_best_fit(counts, cap)
        assert {n: sum(r[2] for r in plan.tolist() if r[0] == n) for n in counts} == dict(counts)
        rooms = []
        for length in sorted(counts.elements(), reverse=True):
            fit = min((r for r in rooms if r >= length), default=None)
            if fit is None:
                rooms.append(cap)
                fit = cap
            rooms.remove(fit)
            rooms.append(fit - length)
        assert len({r[3] + i for r in plan.tolist() for i in range(r[2])}) == len(rooms)
