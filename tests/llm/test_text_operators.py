"""Main text, Ogg media, byte-level BPE, token counts, packing and language identification."""

import hashlib
import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tidemark.llm import byte_bpe, html_extract, language_id, ogg_media, packing, token_counts

RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
WORDS = public_tokenizers.path("word_bpe_49k.json")


# main text
PAGE = """<html><head><title>T</title><style>p{}</style><script>var x="</p>";</script></head><body><header>Site</header><nav><ul><li>Menu</li></ul></nav>
<div class="ad">Buy</div><article><h1>Head&amp;line</h1><p>One <b>bold</b>
 word.<p>Two<br>lines &eacute;<script>no()</script></p><p>x</p><aside>side</aside><form>f<input></form></article><div id="comments"><p>Reader says a long thing here and there.</p></div><div class="cookie-notice">Cookies</div><footer>&copy; F</footer></body></html>"""


def test_main_text_of_an_article():
    assert html_extract.extract(PAGE) == "Head&line\n\nOne bold word.\n\nTwo lines \u00e9\n\nx"


def test_main_text_without_an_article_takes_the_densest_container():
    page = "<body><div class=menu><a>a</a><a>b</a></div><div id=main><p>" + "Long prose text. " * 20 + "</p><p>short</p></div><div class='sidebar-left'><p>links</p></div></body>"
    assert html_extract.extract(page) == ("Long prose text. " * 20).strip() + "\n\nshort"


def test_pages_cut_off_or_empty():
    assert html_extract.extract(None) == html_extract.extract("") == html_extract.extract("<nav>x</nav>") == ""
    assert html_extract.extract("<article><p>One</p><p>Two &amp; thr<") == "One\n\nTwo & thr"
    assert html_extract.extract("<p>plain") == "plain"


def test_html_query_matches_the_article_of_every_page(spark, sf):
    import html
    import re

    pages = spark.read.parquet(f"{sf}/pages.parquet").collect()
    got = {r["page_id"]: (r["text"], r["n_chars"]) for r in html_extract.query(spark, sf).collect()}
    for p in pages:
        article = re.search("<article>(.*?)(</article>|$)", p["html"], re.S)[1].replace("<br>", " ")
        parts = [" ".join(html.unescape(re.sub("<[^>]*>", "", b)).split()) for b in re.split("</?(?:p|h1)>", article)]
        want = "\n\n".join(x for x in parts if x)
        assert got[p["page_id"]] == (want, len(want))


def test_html_frame_keeps_rows_and_columns(spark):
    df = spark.createDataFrame([(1, None, "a"), (1, PAGE, "b"), (2, PAGE, "c")], "page_id long, html string, text string")
    rows = html_extract.extract_main_text(df).collect()
    assert sorted((r["page_id"], r["text"], r["text_input"]) for r in rows) == [(1, "", "a"), (1, html_extract.extract(PAGE), "b"), (2, html_extract.extract(PAGE), "c")]
    assert html_extract.extract_main_text(df.limit(0)).count() == 0


# media
@settings(max_examples=60, deadline=None)
@given(st.binary(max_size=3000), st.integers(0, 200_000))
def test_ogg_round_trip(head, n):
    payload = head + bytes(n)
    media = ogg_media.store(payload)
    back, features = ogg_media.load(media)
    assert back == payload and features["streams"] == 2


def test_ogg_page_checksum_is_the_published_polynomial():
    def slow(data):
        crc = 0
        for byte in data:
            crc ^= byte << 24
            for _ in range(8):
                crc = (crc << 1 ^ 0x04C11DB7 if crc & 0x80000000 else crc << 1) & 0xFFFFFFFF
        return crc

    data = random.Random(1).randbytes(999)
    assert ogg_media.page_crc(data) == slow(data)


def test_ogg_reader_takes_damage_as_errors():
    media = ogg_media.store(bytes(range(256)) * 100)
    for broken in (media[:-1], media[:100] + b"\1" + media[101:], media[300:], media + b"OggS", media.replace(b"OggS", b"OggX", 1)):
        with pytest.raises(ogg_media.OggError):
            ogg_media.load(broken)


def test_media_of_odd_texts(spark, frame, odd):
    rows = {r["doc_id"]: r for r in ogg_media.media_features(ogg_media.to_media(frame(odd, media="x"))).collect()}
    for i, t in enumerate(odd):
        raw = (t or "").encode()
        payload = raw + bytes(max(64, -(-len(raw) // 64) * 64) - len(raw))
        r = rows[i]
        assert (r["n_bytes"], r["payload_bytes"], r["payload_sha256"], r["tail_crc32"]) == (len(raw), len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-64:]))
    assert rows[5]["media_sha256"] == rows[6]["media_sha256"] and rows[5]["feature"] == rows[6]["feature"]


# byte-level BPE
@pytest.fixture(scope="module")
def reference_encoding():
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=byte_bpe.load_ranks(RANKS), special_tokens={})


@settings(max_examples=400, deadline=None)
@given(st.text(st.sampled_from("abcdehn\u00e9\u00df \n\t'stm01.,!?\x1c\x85\u4e2d\u3000\u2003\U0001f600"), max_size=40) | st.text(max_size=30))
def test_bpe_equals_the_library(reference_encoding, text):
    coder = byte_bpe.codec(RANKS)
    got = coder.encode(text)
    assert np.frombuffer(got, "<u4").tolist() == reference_encoding.encode_ordinary(text)
    assert coder.decode(got) == text.encode()


def test_bpe_equals_the_merge_loop_on_long_pieces():
    coder, rng = byte_bpe.codec(RANKS), random.Random(2)
    for _ in range(300):
        piece = "".join(rng.choice(["the", "tion", "a", "an", "\u00e9", "q", "zz"]) for _ in range(rng.randint(1, 12))).encode()
        assert coder.encode_piece(piece) == byte_bpe.merge_by_rank(piece, coder.ranks)


def test_bpe_digest_of_odd_texts(spark, frame, odd, reference_encoding):
    rows = {r["doc_id"]: r for r in byte_bpe.encode_digest(frame(odd, n_tokens="x"), RANKS).collect()}
    for i, t in enumerate(odd):
        ids = reference_encoding.encode_ordinary(t or "")
        assert (rows[i]["n_tokens"], rows[i]["ids_sha256"], rows[i]["decoded_sha256"]) == (len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256((t or "").encode()).hexdigest())
    assert byte_bpe.encode_documents(frame(odd).limit(0), RANKS).count() == 0


# token counts
def counted(pieces, count):
    return sum(map(count, pieces))


def test_edited_trees_equal_counting_anew(monkeypatch):
    monkeypatch.setattr(token_counts, "LEAF", 4)
    count, rng = token_counts.counter(RANKS), random.Random(3)
    alphabet = "abc \u00e9's 12.,!\n\t  \u4e2d  the"
    for k in range(1500):
        x = "".join(rng.choice(alphabet) for _ in range(rng.randint(0, 120)))
        tree = token_counts.TokenTree.build(x, count)
        for _ in range(4):
            a = rng.randint(0, len(x) + 2)
            b, new = a + rng.choice([0, 0, 1, 3, 20]), "".join(rng.choice(alphabet) for _ in range(rng.choice([0, 1, 3, 8, 90 if k % 7 == 0 else 2])))
            x = x[: min(a, len(x))] + new + x[min(max(a, b), len(x)) :]
            tree.edit(a, b, new)
            pieces = byte_bpe.PATTERN.findall(x)
            text, lengths, counts = tree.state()
            assert text == x and lengths == list(map(len, pieces)) and counts == list(map(count, pieces))
            assert tree.tokens == sum(counts) and tree.length == len(x)


def test_edits_encode_little_of_a_long_text():
    tree = token_counts.TokenTree.build("word and more " * 20_000, token_counts.counter(RANKS))
    tree.edit(100_000, 100_004, "other")
    assert tree.encoded < 60


def test_leaves_split_after_a_long_insertion():
    tree = token_counts.TokenTree.build("a few words", token_counts.counter(RANKS))
    tree.edit(2, 2, "word and more " * 100_000)
    assert max(len(x[1]) for x in tree.leaves) <= 2 * token_counts.LEAF
    before = tree.encoded
    for k in range(50):
        tree.edit(20_000 * k, 20_000 * k + 4, "other")
    assert tree.encoded - before < 50 * 60


def test_edited_counts_of_odd_texts(spark, frame, odd):
    df = frame(odd, n_tokens="x", Counts="y", n_edits="z")
    trees = token_counts.token_trees(df, RANKS)
    assert {(r["n_tokens_input"], r["Counts_input"], r["n_edits"]) for r in trees.collect()} == {("x", "y", "z")}
    trees = trees.withColumn("edits", F.when(F.col("doc_id") != 3, token_counts.review_edits(F.col("text"))))
    count = token_counts.counter(RANKS)
    rows = {r["doc_id"]: r for r in token_counts.edit_trees(trees, RANKS).collect()}
    edits = {r["doc_id"]: r["edits"] for r in trees.collect()}
    for i, t in enumerate(odd):
        x = t or ""
        assert rows[i]["n_tokens"] == counted(byte_bpe.PATTERN.findall(x), count) and rows[i]["n_edits_input"] == "z"
        for e in edits[i] or []:
            a, b = min(e["start"], len(x)), min(max(e["start"], e["end"]), len(x))
            x = x[:a] + e["replacement"] + x[b:]
        assert (rows[i]["n_tokens_edited"], rows[i]["n_chars_edited"], rows[i]["text"]) == (counted(byte_bpe.PATTERN.findall(x), count), len(x), x)
    assert token_counts.token_trees(df.limit(0), RANKS).count() == 0


def test_a_second_run_encodes_only_edits(spark, sf, tmp_path):
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text")
    token_counts.token_trees(docs, RANKS).write.parquet(str(tmp_path / "1"))
    trees = spark.read.parquet(str(tmp_path / "1"))
    for run in (2, 3):
        edit = F.when(F.length("text") > 10_000, F.array(F.struct(F.lit(5000).alias("start"), F.lit(5004).alias("end"), F.lit("other").alias("replacement"))))
        token_counts.edit_trees(trees.withColumn("edits", edit), RANKS).drop(*token_counts.EDITED[2:]).write.parquet(str(tmp_path / f"{run}"))
        done = spark.read.parquet(str(tmp_path / f"{run}"))
        total = done.agg(F.sum("n_chars_encoded").alias("encoded"), F.sum(F.length("text")).alias("chars"), F.sum("n_edits").alias("edits")).first()
        assert total["edits"] > 0 and total["encoded"] < 0.01 * total["chars"]
        trees = done.drop("n_edits", "n_chars_encoded")
    assert trees.filter(F.length("lengths") != F.length("counts")).count() == 0


def test_token_count_query_equals_counting_anew(spark, sf):
    docs = {r["doc_id"]: r for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text", token_counts.review_edits(F.col("text")).alias("edits")).collect()}
    ours = tiktoken.Encoding("counts", pat_str=public_tokenizers.PATTERN, mergeable_ranks=byte_bpe.load_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken")), special_tokens={})
    rows = {r["doc_id"]: r for r in token_counts.query(spark, sf).collect()}
    assert len(rows) == len(docs)
    for i, d in docs.items():
        x = d["text"] or ""
        assert rows[i]["n_tokens"] == len(ours.encode_ordinary(x))
        for e in d["edits"]:
            a, b = min(e["start"], len(x)), min(max(e["start"], e["end"]), len(x))
            x = x[:a] + e["replacement"] + x[b:]
        assert (rows[i]["n_tokens_edited"], rows[i]["n_chars_edited"]) == (len(ours.encode_ordinary(x)), len(x))


# the other queries as registered, over the whole table
def test_media_query_equals_brute_force(spark, sf):
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    rows = {r["doc_id"]: r for r in ogg_media.query(spark, sf).collect()}
    assert rows.keys() == docs.keys()
    for i, t in docs.items():
        raw = (t or "").encode()
        payload = raw + bytes(max(64, -(-len(raw) // 64) * 64) - len(raw))
        media = ogg_media.store(payload)
        r = rows[i]
        assert (r["n_bytes"], r["payload_bytes"], r["payload_sha256"], r["tail_crc32"]) == (len(raw), len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-64:]))
        assert (r["media_bytes"], r["media_sha256"]) == (len(media), hashlib.sha256(media).hexdigest())


def test_bpe_query_equals_the_library(spark, sf):
    ours = tiktoken.Encoding("query", pat_str=public_tokenizers.PATTERN, mergeable_ranks=byte_bpe.load_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken")), special_tokens={})
    rows = {r["doc_id"]: r for r in byte_bpe.query(spark, sf).collect()}
    docs = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    assert rows.keys() == docs.keys()
    for i, t in docs.items():
        ids = ours.encode_ordinary(t)
        r = rows[i]
        assert (r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) == (len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(t.encode()).hexdigest())


def test_packing_query_places_every_token_once(spark, sf):
    coder = Tokenizer.from_file(WORDS)
    ids = {r["doc_id"]: [*coder.encode(r["text"] or "", add_special_tokens=False).ids, 2] for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    pieces, sequences = defaultdict(list), defaultdict(list)
    for r in packing.query(spark, sf).collect():
        own = np.array(ids[r["doc_id"]][r["start"] : r["start"] + r["length"]], "<u4")
        assert r["ids_crc32"] == zlib.crc32(own.tobytes()) and r["doc_tokens"] == len(ids[r["doc_id"]])
        pieces[r["doc_id"]].append((r["start"], r["length"]))
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    assert pieces.keys() == ids.keys()
    for i, found in pieces.items():
        at = 0
        for start, length in sorted(found):
            assert start == at and length > 0
            at += length
        assert at == len(ids[i])
    padding = 0
    for found in sequences.values():
        at = 0
        for offset, length in sorted(found):
            assert offset == at
            at += length
        assert at <= 4096
        padding += 0 if at & (at - 1) == 0 else 4096 - at
    assert padding < 0.01 * sum(map(len, ids.values()))


def test_packing_of_instruction_data_keeps_all_three_limits(spark, sf):
    """Prompt and answer of the conversations: prompts carry no loss, and tokens, segments and loss tokens all bind somewhere."""
    turns = spark.read.parquet(f"{sf}/conversations.parquet").filter("role = 'user' OR role = 'assistant'")
    pairs = turns.groupBy("conv_id").agg(F.concat_ws(" ", F.collect_list(F.when(F.col("role") == "user", F.col("text")))).alias("prompt"), F.concat_ws(" ", F.collect_list(F.when(F.col("role") == "assistant", F.col("text")))).alias("answer"))
    limits = packing.Limits(tokens=400, segments=4, loss=160)
    rows = packing.pack_documents(pairs, WORDS, key="conv_id", text="answer", prompt="prompt", limits=limits).collect()
    coder = Tokenizer.from_file(WORDS)
    heads = {r["conv_id"]: len(coder.encode(r["prompt"], add_special_tokens=False).ids) for r in pairs.collect()}
    used = defaultdict(lambda: [0, 0, 0])
    for r in rows:
        u = used[r["sequence_id"]]
        u[0] += r["length"]
        u[1] += 1
        u[2] += max(0, r["start"] + r["length"] - max(r["start"], heads[r["conv_id"]]))
    assert all(u[0] <= 400 and u[1] <= 4 and u[2] <= 160 for u in used.values())
    assert max(u[0] for u in used.values()) > 400 - packing.LEAST_CUT and max(u[1] for u in used.values()) == 4 and max(u[2] for u in used.values()) > 160 - packing.LEAST_CUT


def test_many_empty_texts_pack_in_time(spark):
    import time

    df = spark.range(200_000).selectExpr("id AS doc_id", "IF(id % 2 = 0, '', CAST(NULL AS STRING)) AS text")
    t = time.perf_counter()
    assert packing.pack_documents(df, WORDS).agg(F.sum("length")).first()[0] == 200_000
    assert time.perf_counter() - t < 60


# packing
@settings(max_examples=60, deadline=None)
@given(st.lists(st.tuples(st.integers(1, 300), st.integers(0, 300)), max_size=40), st.integers(2, 20))
def test_packing_keeps_limits_and_every_token_once(sizes, segments):
    limits = packing.Limits(tokens=100, segments=segments, loss=60)
    items = [packing.Piece(k, 0, n, min(p, n)) for k, (n, p) in enumerate(sizes)]
    full, last = packing.pack(items, limits)
    seen = {}
    for s in [*full, last]:
        assert sum(p.length for p in s) <= 100 and len(s) <= segments and sum(p.sizes[2] for p in s) <= 60
        for p in s:
            seen.setdefault(p.example, []).append((p.start, p.length))
    for k, (n, _) in enumerate(sizes):
        at = 0
        for start, length in sorted(seen[k]):
            assert start == at and length > 0
            at += length
        assert at == n


def test_powers_of_two():
    parts = packing.powers([packing.Piece("a", 0, 700), packing.Piece("b", 5, 800)])
    assert [sum(p.length for p in s) for s in parts] == [1024, 256, 128, 64, 16, 8, 4]


def test_packed_documents(spark, frame, odd):
    texts = [*odd, "<|endoftext|> and \u0130stanbul \u03a3\u0391\u03a3 e\u0301 don't 12.5", "a b c " * 4000]
    library = Tokenizer.from_file(WORDS)
    rows = packing.pack_documents(frame(texts, ids="x"), WORDS).collect()
    pieces, sequences = {}, {}
    for r in rows:
        pieces.setdefault(r["doc_id"], []).append((r["start"], bytes(r["ids"])))
        sequences.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for i, t in enumerate(texts):
        ids = np.array([*library.encode(t or "", add_special_tokens=False).ids, 2], "<u4").tobytes()
        assert b"".join(b for _, b in sorted(pieces[i])) == ids
    for s in sequences.values():
        at = 0
        for offset, length in sorted(s):
            assert offset == at
            at += length
        assert at <= 4096 and (at & (at - 1) == 0 or at > 4096 - packing.LEAST_CUT)


def test_prompts_carry_no_loss(spark):
    df = spark.createDataFrame([(1, "question one two", "answer"), (2, None, "b")], "doc_id long, prompt string, text string")
    rows = packing.pack_documents(df, WORDS, prompt="prompt").collect()
    assert sum(r["length"] for r in rows) == sum({r["doc_id"]: r["doc_tokens"] for r in rows}.values())
    piece = packing.Piece("x", 2, 10, prompt=5)
    assert piece.sizes == (10, 1, 7) and [p.sizes[2] for p in piece.cut(2)] == [0, 7]
    # 40 answers of five loss tokens behind prompts of 20: the limit of 16 loss tokens closes a sequence after three.
    df = spark.createDataFrame([(k, "one two three four five " * 4, "one two three four") for k in range(40)], "doc_id long, prompt string, text string").coalesce(1)
    rows = packing.pack_documents(df, WORDS, prompt="prompt", limits=packing.Limits(tokens=4096, segments=100, loss=16)).collect()
    assert len({r["sequence_id"] for r in rows}) >= 40 * 5 / 16


# language identification
def test_language_arrays_are_those_of_a_group_of_texts_of_like_length(monkeypatch):
    crf = language_id.train(["the cat sat on the mat " * 9, "der hund lief durch den wald " * 9], ["en", "de"])
    rng = np.random.default_rng(1)
    texts = ["", "123", *(("the mat " if k % 2 else "der wald ") * int(n) for k, n in enumerate(rng.integers(1, 2000, 900)))]
    seen, real = [], language_id.forward_backward
    monkeypatch.setattr(language_id, "forward_backward", lambda scores, counts, *a: (seen.append((len(scores), counts.min(), counts.max())), real(scores, counts, *a))[1])
    found = language_id.classify_surely(texts, crf)
    assert sum(map(len, texts)) > 6 * language_id.GROUP_CHARS and sum(n for n, _, _ in seen) == sum(len(x.split()) for x in texts[2:])
    assert max(n for n, _, _ in seen) <= language_id.GROUP_CHARS / 4
    assert all(1.2 * least >= longest for (_, least, _), (_, _, longest) in zip(seen, seen[1:], strict=False))  # words of the two texts differ in length
    alone = [language_id.classify_surely([x], crf)[0] for x in texts[:200]]
    assert [x[0] for x in found[:200]] == [x[0] for x in alone] and np.allclose([x[1:] for x in found[:200]], [x[1:] for x in alone], atol=1e-6)
    assert language_id.classify_surely([], crf) == []


def test_forward_backward_equals_enumeration():
    import itertools

    rng = np.random.default_rng(0)
    counts = np.array([4, 6, 1])
    scores, moves, start = rng.normal(size=(11, 3)).astype(np.float32), rng.normal(size=(3, 3)), rng.normal(size=3)
    got, expected = language_id.forward_backward(scores, counts, moves, start)
    at, pairs = 0, np.zeros((3, 3))
    for n in counts:
        total, m, e = 0.0, np.zeros((n, 3)), np.zeros((3, 3))
        for y in itertools.product(range(3), repeat=int(n)):
            w = np.exp(start[y[0]] + sum(scores[at + i, y[i]] for i in range(n)) + sum(moves[y[i - 1], y[i]] for i in range(1, n)))
            total += w
            for i in range(n):
                m[i, y[i]] += w
            for i in range(1, n):
                e[y[i - 1], y[i]] += w
        assert np.allclose(m / total, got[at : at + n], atol=1e-4)
        pairs += e / total
        at += n
    assert np.allclose(pairs, expected, atol=1e-3)


@pytest.fixture(scope="module")
def held_out(spark):
    rows = {r["doc_id"]: r for r in language_id.query(spark, "/root/testdata/sf0.01").collect()}
    truth = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "lang").collect()
    return [(rows[r["doc_id"]], r["lang"]) for r in truth]


def test_held_out_accuracy(held_out):
    tested = [(r, lang) for r, lang in held_out if r["held_out"]]
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1) for r, _ in held_out)
    assert sum(r["lang_pred"] == lang for r, lang in tested) / len(tested) > 0.98
    assert all(0 <= r["score"] <= 1 for r, _ in held_out)


def test_switched_text_is_labelled_word_by_word(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    crf = language_id.fit(docs)
    long = {lang: " ".join(docs.filter(f"lang = '{lang}' AND length(text) > 900").first()["text"].split()[:40]) for lang in ("en", "de")}
    marginals, words = language_id.label_texts([long["en"] + " " + long["de"]], crf)
    labels = [crf.labels[k] for k in marginals[0].argmax(1)]
    half = len(language_id.featurize(long["en"].lower().encode()).size)
    right = sum(x == "en" for x in labels[:half]) + sum(x == "de" for x in labels[half:])
    assert right / len(labels) > 0.9 and len(words[0]) == len(labels)


def test_language_of_odd_texts(spark, frame, odd):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    crf = language_id.fit(docs)
    rows = {r["doc_id"]: r for r in language_id.predict(frame([*odd, "123 ..."], score="x", lang="zz"), crf).collect()}
    assert [rows[i]["lang_pred"] for i in (0, 1, 2, 9, 10)] == ["und"] * 5 and rows[0]["score"] == 0
    assert abs(rows[5]["score"] - rows[6]["score"]) < 1e-5 and rows[3]["lang_pred"] in crf.labels
    nothing = language_id.fit(docs.limit(0))
    assert {r["lang_pred"] for r in language_id.predict(frame(odd), nothing).collect()} == {"und"}
    assert language_id.predict(frame(odd).limit(0), crf).count() == 0


def test_packing_ids_of_letters_that_come_apart_before_stops():
    """Every letter that normalization makes several characters of, and every other one up to U+3400, before a stop and a comma."""
    import unicodedata

    from tokenizers import Tokenizer

    library = Tokenizer.from_file(WORDS)
    library.no_truncation()
    library.no_padding()
    ours = packing.PartEncoder(WORDS)
    chars = [chr(c) for c in range(0x21, 0x3400)] + [c for c in map(chr, range(0x3400, 0x30000)) if not 0xD800 <= ord(c) < 0xE000 and len(unicodedata.normalize("NFC", c)) > 1]
    texts = [f.replace("{}", c) for c in chars for f in ("a{}, b", "{}. b", "x{}{}. {}, y")]
    want = [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]
    assert [np.frombuffer(x, "<u4").tolist() for x in ours.encode_all(texts)] == want
    assert np.frombuffer(ours.encode_all(["\u0130. Melih"])[0], "<u4").tolist() == library.encode("\u0130. Melih", add_special_tokens=False).ids
