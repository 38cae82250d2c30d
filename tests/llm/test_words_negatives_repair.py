"""Distinct-word BPE, hard negatives and conversation repair against plain versions."""

import hashlib
import random
import re
import zlib
from functools import lru_cache

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from oracle import check
from pyspark.sql import functions as F
from tokenizers import Regex, Tokenizer, pre_tokenizers

from tidemark.llm import byte_bpe, conversation_repair, hard_negatives, word_bpe

# --- distinct-word BPE -----------------------------------------------------------------------------------------------

JSON = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def library():
    found = Tokenizer.from_file(JSON)
    found.no_truncation()
    found.no_padding()
    return found


def coded(library, x):
    ids = library.encode(x or "", add_special_tokens=False).ids
    return len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(library.decode(ids, skip_special_tokens=False).encode()).hexdigest()


SPECIAL = ["<|endoftext|>", "foo  <|endoftext|> bar<|endoftext|><|endoftext|>  ", "a\0b", "\x1c\x1d\x85᠎ x", "՘a ࢏1 \U00011de0", "don't we'll I'D 'sx", "́‍﻿"]


def test_word_bpe_equals_the_library(frame, odd, library):
    texts = [*odd, *SPECIAL]
    rows = word_bpe.encode_digest(frame(texts), JSON, block_chars=2000).collect()
    assert {r["doc_id"]: tuple(r)[1:] for r in rows} == {i: coded(library, x) for i, x in enumerate(texts)}


def test_word_bpe_keeps_other_columns_and_decodes_any_ids(spark, frame, library):
    docs = frame(["one two", None], ids="mine", block="b", **{"Positions": "p"})
    found = word_bpe.encode_documents(docs, JSON)
    assert set(found.columns) == {"doc_id", "ids_input", "block_input", "Positions_input", "ids"}
    assert {r["doc_id"]: (r["ids_input"], r["ids"]) for r in found.collect()} == {0: ("mine", library.encode("one two").ids), 1: ("mine", [])}
    ids = [[0, 5, 50256], [220], [10, 447, 99999], [], None]
    rows = word_bpe.decode_documents(spark.createDataFrame([(i, x) for i, x in enumerate(ids)], "k int, ids array<int>"), JSON).collect()
    want = {i: x and library.decode([k for k in x if k < 50257], skip_special_tokens=False) for i, x in enumerate(ids)}
    assert {r["k"]: r["decoded"] for r in rows} == want | {3: ""}


def test_word_bpe_of_an_empty_table(spark):
    assert word_bpe.encode_digest(spark.createDataFrame([], "doc_id long, text string"), JSON).collect() == []


def test_word_bpe_query(spark, sf, library):
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    assert {r["doc_id"]: tuple(r)[1:] for r in word_bpe.query(spark, sf).collect()} == {i: coded(library, x) for i, x in texts.items()}


def every_character():
    return [chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000]


@pytest.mark.parametrize("kind", [r"\p{L}", r"\p{N}"])
def test_both_libraries_have_the_same_classes(kind):
    own = pre_tokenizers.Split(Regex(kind.replace("p", "P") + "+"), "removed").pre_tokenize_str("".join(every_character()))
    assert set("".join(x for x, _ in own)) == byte_bpe._engine(kind)


def test_every_code_point_is_cut_as_the_libraries_cut_it():
    """Each character beside a letter, a digit, a sign and spaces, by the pattern, the byte-level encoder and tiktoken."""
    ranks = byte_bpe.load_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
    theirs = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    ours = byte_bpe.ByteBpe(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
    for some in range(0x20, 0x34000, 0x400):
        chars = [chr(c) for c in range(some, some + 0x400) if not 0xD800 <= c < 0xE000]
        for frame in ("x{}y 1{}2 !{}?", "  {}  {}a"):
            text = "\n".join(frame.replace("{}", c) for c in chars)
            assert np.frombuffer(ours.encode(text), "<u4").tolist() == theirs.encode_ordinary(text), hex(some)


# --- hard negatives --------------------------------------------------------------------------------------------------


def test_hard_negatives_query(spark, sf):
    check(spark, sf, hard_negatives.query, hard_negatives.SQL)


def mined(rows, anchor, positives=5, negatives=10):
    ok = [(i, lab, [int(np.floor(256 * x)) for x in v]) for i, v, lab in rows if None not in (i, lab, v) and all(x is not None and np.isfinite(x) for x in v)]
    dot = lambda a, b: sum(x * y for x, y in zip(a, b, strict=False))
    out = set()
    for i, lab, v in {r[0]: r for r in sorted(ok, reverse=True)}.values():
        if anchor(i):
            scores = sorted((-dot(v, w), j, m) for j, m, w in ok if j != i)
            for s, p, _ in [x for x in scores if x[2] == lab][:positives]:
                fits = [x for x in scores if x[2] != lab and 30 * -s <= 100 * -x[0] <= 90 * -s][:negatives]
                out |= {(i, p, k + 1, j, -s, -t) for k, (t, j, _) in enumerate(fits)}
    return out


@pytest.mark.parametrize("d", [1, 7, 33])
def test_hard_negatives_against_all_scores(spark, d):
    rng = random.Random(d)
    rows = [(i, [round(rng.gauss(0.2, 0.4), 2) for _ in range(d)], rng.randrange(4)) for i in range(300)]
    rows += [(300 + i, rows[i][1], rows[i][2]) for i in range(0, 60, 3)]  # ties
    rows += [(500, None, 1), (501, [0.1] * d, None), (502, [float("nan")] * d, 1), (503, [float("inf")] * d, 1), (504, [None] * d, 1), (505, [], 1), (None, [0.1] * d, 1), (506, [0.0] * d, 2), (507, [0.5] * (d + 3), 3)]
    df = spark.createDataFrame([(*r, "x") for r in rows], "vec_id long, embedding array<float>, label int, place string")
    single = [(i, None if v is None else [None if x is None else float(np.float32(x)) for x in v], lab) for i, v, lab in rows]
    found = hard_negatives.mine(df, lambda i: i % 5 == 0, rows_per_cell=40, anchors_per_cell=17, block_rows=16).collect()
    want = mined(single, lambda i: i % 5 == 0)
    assert len(found) == len(want) and {tuple(r) for r in found} == want


def test_hard_negatives_of_large_components_and_of_nothing(spark):
    rows = [(i, [float((-1) ** i * 200_000 - i), 3.0 * i, 250_000.0], i % 2) for i in range(12)] + [(90, [1e30, 0.0, 0.0], 0)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    assert {tuple(r) for r in hard_negatives.mine(df, lambda i: i == 0).collect()} == mined(rows[:-1], lambda i: i == 0)
    assert hard_negatives.mine(df.limit(0), lambda i: i == 0).collect() == []


def test_the_scan_drops_candidates_early():
    rng = np.random.default_rng(0)
    row = {"n": 4096, "d": 64, "ids": np.arange(4096, dtype="<i8").tobytes(), "labels": np.zeros(4096, "<i8").tobytes(), "dims": rng.integers(-50, 50, (64, 4096), dtype="<i4").tobytes()}
    block, seen = hard_negatives.Block(row), []
    anchor = np.where(np.arange(64) < 6, 900, 2)

    def prune(low, high):
        seen.append(len(low))
        return high >= hard_negatives._kth(low, 5, hard_negatives.NONE)

    alive, scores = hard_negatives.vertical_scan(block, anchor, np.arange(4096), prune)
    exact = anchor @ block.dims
    assert set(np.argsort(-exact)[:5]) <= set(alive) and (scores == exact[alive]).all()
    assert seen[1] < 1000


# --- conversation repair ---------------------------------------------------------------------------------------------

STANDS = {("", "s"), ("", "u"), ("s", "u"), ("u", "a"), ("a", "u")}


def plain(rows):
    """The result of one conversation's rows (turn, role, text) in order, by cheapest (cost, audit) from the end."""
    seen, faults = set(), []
    for _, r, x in rows:
        end = x.rstrip(" \t\n\v\f\r")
        faults.append("blank" if not end else "duplicate" if (r, x) in seen else "truncated" if end[-1] not in ".!?" else "")
        seen.add((r, x))

    @lru_cache(None)
    def best(i, state, inserts):
        found = [(0, "", ())] if i == len(rows) and state in ("", "a") else []

        def more(cost, letter, then, *line):
            if then:
                found.append((cost + then[0], letter + then[1], line + then[2]))

        for c, w in (("u", "user"), ("a", "assistant")):
            if inserts < 3 and (state, c) in STANDS:
                more(2, "I", best(i, c, inserts + 1), f"{w}:")
        if i < len(rows):
            (_, r, x), extra = rows[i], faults[i] == "truncated"
            more(3, "D", best(i + 1, state, 0))
            if faults[i] not in ("blank", "duplicate"):
                if (state, r[:1]) in STANDS:
                    more(extra, "K", best(i + 1, r[:1], 0), f"{r}:{x}")
                for c, w in (("u", "user"), ("a", "assistant")):
                    if (state, c) in STANDS:
                        more(2 + extra, "R", best(i + 1, c, 0), f"{w}:{x}")
        return min(found, default=None)

    cost, audit, lines = best(0, "", 0)
    turns = [t for t, *_ in rows if t is not None]
    illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:], strict=False))
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    return gaps, *(faults.count(k) for k in ("blank", "duplicate", "truncated")), illegal, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest()


def brute(table):
    conversations, said = {}, lambda v: " " if v is None else str(v)
    for conv, turn, role, text in table:
        own = conversations.setdefault(conv, [])
        fate = zlib.crc32(f"{said(conv)}:{said(turn)}".encode()) % 20
        text = "" if fate == 1 else re.sub("[.!?]", "", said(text)) if fate == 2 else said(text)
        own += [(turn, "user" if fate == 4 else said(role), text)] * (0 if fate == 0 else 2 if fate == 3 else 1)
    return {c: plain(sorted(r, key=lambda x: (x[0] is not None, x[0] or 0, x[1], x[2]))) for c, r in conversations.items()}


def repair_all(spark, table, **more):
    df = spark.createDataFrame(table, "conv_id long, turn long, role string, text string")
    rows, kept = conversation_repair.damaged(df)
    return conversation_repair.repair(rows.withColumn("gaps", F.lit("x")), kept=kept, **more).collect()


@pytest.mark.parametrize("rows", [2, 7, 2048])
def test_repair_of_odd_conversations(spark, rows):
    """Nulls in every column, ties, repeated rows, unknown roles, a conversation with half of all rows; short segments cut most conversations."""
    r = random.Random(rows)
    roles, texts = ["user", "assistant", "system", "tool", None, "", "u"], ["Hi.", "Hi.", "yes", "ok?", "a!b", " ", None, "", "x\t", "longer text\n.", "é\x85", "Zz!"]
    table = [(r.choice([None, *range(40)]) if r.random() < 0.5 else 0, r.choice([None, *range(9)]) if r.random() < 0.9 else r.randrange(500), r.choice(roles), r.choice(texts)) for _ in range(300)]
    found = repair_all(spark, table, segment_rows=rows)
    want = brute(table)
    assert len(found) == len(want) and {x["conv_id"]: tuple(x)[1:] for x in found} == want


def test_repair_of_nothing_and_of_long_texts(spark):
    assert repair_all(spark, []) == []
    table = [(1, k, ("user", "assistant")[k % 2], ("word " * 20_000) + "." * (k % 3)) for k in range(9)]
    found = repair_all(spark, table, segment_chars=250_000)
    assert {x["conv_id"]: tuple(x)[1:] for x in found} == brute(table)


def test_repair_query(spark, sf):
    table = [tuple(r) for r in spark.read.parquet(f"{sf}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    found = conversation_repair.query(spark, sf).collect()
    assert {x["conv_id"]: tuple(x)[1:] for x in found} == brute(table) and len(found) == len(brute(table))


def test_a_hot_conversation_is_many_tasks(spark):
    rows = spark.range(30_000).select(F.lit(1).alias("conv_id"), F.col("id").alias("turn"), F.when(F.col("id") % 2 == 0, "user").otherwise("assistant").alias("role"), F.concat(F.lit("text "), F.col("id") % 20_000, F.lit(".")).alias("text"))
    found = conversation_repair.repair(rows).collect()
    assert len(found) == 1 and (found[0]["duplicate"], found[0]["cost"], found[0]["audit"]) == (10_000, 30_000, "K" * 20_000 + "D" * 10_000)
