"""Substring dedup, SimHash near-dedup and the pipeline."""

import random
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import public_tokenizers
import xxhash
from oracle import check
from tokenizers import Tokenizer

from tidemark.llm import quality_cascade, similar_texts, simhash, substring_dedup


def test_substring_query_agrees_with_its_sql(spark, sf):
    check(spark, sf, substring_dedup.query, substring_dedup.SQL)


def brute_cut(texts, width):
    words = [(t or "").encode().split() for t in texts]
    seen = Counter(tuple(w[i : i + width]) for w in words for i in range(len(w) - width + 1))
    kept = []
    for w in words:
        gone = {i + k for i in range(len(w) - width + 1) if seen[tuple(w[i : i + width])] > 1 for k in range(width)}
        kept.append([x for i, x in enumerate(w) if i not in gone])
    return kept


def test_substring_dedup_equals_brute_force(spark, frame, odd):
    rng = random.Random(5)
    for width, vocabulary in ((2, 12), (3, 6), (5, 3)):
        texts = [" ".join(rng.choice("abcdefghijkl"[:vocabulary]) for _ in range(rng.randint(0, 30))) + rng.choice(["", "\n", "\t x"]) for _ in range(40)] + odd
        rows = {r["doc_id"]: r for r in substring_dedup.remove_repeats(frame(texts, n_words="x", _key="y", _first="z", _END="w", _salt="v", _salts="u", count="t"), width=width).collect()}
        for i, kept in enumerate(brute_cut(texts, width)):
            assert (rows[i]["text"] or "").encode().split() == kept
            assert rows[i]["n_words"] - rows[i]["n_removed"] == len(kept)
            assert [rows[i][c] for c in ("n_words_input", "_key", "_first", "_END", "_salt", "_salts", "count")] == list("xyzwvut")
        assert rows[40]["text"] is None


def test_substring_dedup_of_an_empty_table_and_small_buckets(spark, frame):
    assert substring_dedup.remove_repeats(frame(["a"]).limit(0)).count() == 0
    texts = ["q " + "a b c d e f g", "a b c d e f g z", "lone words here only"]
    found = substring_dedup.repeated_intervals(frame(texts), 50, width=3, bucket_windows=1).collect()
    assert sorted((r["first"], r["end"]) for r in found) == [([0], [7]), ([1], [8])]


def test_word_hashes_do_not_depend_on_where_a_word_stands(monkeypatch):
    monkeypatch.setattr(substring_dedup, "_STEP", 64)
    data = b"alpha beta " * 50 + b"x" * 300 + b" alpha\tbeta"
    h, starts = substring_dedup.word_hashes(data)
    words = data.split()
    assert len(h) == len(words) and [data[s : s + len(w)] for s, w in zip(starts, words, strict=True)] == words
    assert len(set(h.tolist())) == len(set(words)) == 3


def brute_print(text):
    words = (text or "").encode().translate(bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))).split()
    shingles = [b" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))] if words else []
    hashes = [xxhash.xxh64(s, seed=42).intdigest() for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(ids, prints, radius=4):
    parent = list(range(len(ids)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(ids)):
        for j in range(i):
            if bin(prints[i] ^ prints[j]).count("1") <= radius:
                parent[find(i)] = find(j)
    groups = defaultdict(list)
    for i in range(len(ids)):
        groups[find(i)].append(ids[i])
    return [min(x for x in groups[find(i)]) for i in range(len(ids))]


def test_simhash_query_equals_brute_force(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()
    prints = [brute_print(r["text"]) for r in docs]
    roots = brute_components([r["doc_id"] for r in docs], prints)
    got = {r["doc_id"]: (r["fingerprint"], r["component_id"]) for r in simhash.query(spark, sf).collect()}
    assert got == {r["doc_id"]: (f"{p:016x}", c) for r, p, c in zip(docs, prints, roots, strict=True)}


def test_links_lose_none_whatever_the_tiles(spark):
    rng = np.random.default_rng(6)
    centres = rng.integers(0, 1 << 63, 12, np.uint64)
    values = {0, (1 << 64) - 1}
    for c in centres.tolist():
        for _ in range(25):
            x = c
            for b in rng.integers(0, 64, rng.integers(0, 7)).tolist():
                x ^= 1 << int(b)
            values.add(x)
    signed = [v - (1 << 64) if v >> 63 else v for v in sorted(values)]
    nodes = spark.createDataFrame([(v,) for v in signed], "fingerprint long")
    order = sorted(signed)
    want = dict(zip(order, brute_components(order, [v & (1 << 64) - 1 for v in order]), strict=True))
    for hot in (20_000, 8):
        roots = {r["node"]: r["root"] for r in simhash.components(simhash.links(nodes, hot=hot)).collect()}
        assert {v: roots.get(v, v) for v in order} == want


def test_tiles_equal_a_single_comparison():
    rng = np.random.default_rng(8)
    base = rng.integers(0, 1 << 63, 3, np.uint64)
    x = np.unique(base[rng.integers(0, 3, 400)] ^ (np.uint64(1) << rng.integers(0, 64, 400).astype(np.uint64)) ^ (np.uint64(1) << rng.integers(0, 64, 400).astype(np.uint64)))
    x = x[np.argsort(np.bitwise_count(x), kind="stable")]
    labels = []
    for tile in (7, 4096):
        f = simhash._Forest(len(x))
        simhash.compare_tiles(x, np.bitwise_count(x), f, 0, 4, tile)
        labels.append(f.label.tolist())
    assert labels[0] == labels[1]


def test_near_copies_of_odd_texts(spark, frame, odd):
    rows = {r["doc_id"]: r for r in simhash.near_duplicates(frame(odd, fingerprint="x")).collect()}
    assert [rows[i]["component_id"] for i in (0, 1, 2)] == [0, 0, 0] and rows[0]["fingerprint"] == 0
    assert rows[6]["component_id"] == 5
    kept = similar_texts.keep_one(frame(odd, _key="x", _id="y", _SALT="z", digest="w", band="v"))
    assert sorted(r["doc_id"] for r in kept.collect()) == brute_near_copies(list(range(len(odd))), odd)
    assert kept.columns == ["doc_id", "text", "_key", "_id", "_SALT", "digest", "band"] and {r["_key"] for r in kept.collect()} == {"x"}
    assert simhash.near_duplicates(frame(odd).limit(0)).count() == 0 and similar_texts.keep_one(frame(odd).limit(0)).count() == 0


def test_one_of_repeated_rows_and_null_ids_stays(spark):
    rows = [(None, "one text with some words"), (None, "one text with some words"), (7, "quite another text it is, to be sure"), (7, "quite another text it is, to be sure"), (None, "quite another text it is, to be sure")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    kept = [tuple(r) for r in similar_texts.keep_one(df).collect()]
    assert sorted(kept, key=str) == sorted([(None, "one text with some words"), (7, "quite another text it is, to be sure")], key=str)


def test_pipeline_stage_by_stage(spark, tmp_path):
    import corpus_pipeline as cp

    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    assert [n for n, _ in cp.STAGES] == ["language_id", "quality_rules", "near_dedup", "substring_dedup", "packing"]
    at, seen = docs, {}
    for k, (name, stage) in enumerate(cp.STAGES):
        stage(spark, at, sf).write.parquet(str(tmp_path / f"{k}"))
        before, at = at, spark.read.parquet(str(tmp_path / f"{k}"))
        seen[name] = (before, at)
        assert k == 4 or at.columns == docs.columns
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/0/*.parquet'")
    kept = sorted(i for i, good in con.execute(f"SELECT doc_id, kept FROM ({quality_cascade.SQL})").fetchall() if good)
    assert sorted(r["doc_id"] for r in seen["quality_rules"][1].collect()) == kept and len(kept) < seen["quality_rules"][0].count()
    before, after = seen["near_dedup"]
    ids = [r["doc_id"] for r in before.collect()]
    assert sorted(r["doc_id"] for r in after.collect()) == brute_near_copies(ids, [r["text"] for r in before.collect()])
    before, after = seen["substring_dedup"]
    order = before.orderBy("doc_id").collect()
    got = {r["doc_id"]: r for r in after.collect()}
    for r, kept in zip(order, brute_cut([r["text"] for r in order], 35), strict=True):
        assert got[r["doc_id"]]["text"].encode().split() == kept and got[r["doc_id"]]["n_chars"] == len(got[r["doc_id"]]["text"])
    before, after = seen["packing"]
    coder = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    ids = {r["doc_id"]: [*coder.encode(r["text"] or "", add_special_tokens=False).ids, 2] for r in before.collect()}
    pieces = defaultdict(list)
    for r in after.collect():
        own = np.array(ids[r["doc_id"]][r["start"] : r["start"] + r["length"]], "<u4")
        assert r["ids_crc32"] == zlib.crc32(own.tobytes()) and r["doc_tokens"] == len(ids[r["doc_id"]])
        pieces[r["doc_id"]].append((r["start"], r["length"]))
    for i, own in ids.items():
        ends = [0, *(start + length for start, length in sorted(pieces[i]))]
        assert [start for start, _ in sorted(pieces[i])] == ends[:-1] and ends[-1] == len(own)
    assert seen["language_id"][1].count() > 0.9 * docs.count()


def test_pipeline_of_an_empty_table(spark, tmp_path):
    import corpus_pipeline as cp

    spark.read.parquet("/root/testdata/sf0.001/documents.parquet").limit(0).write.parquet(str(tmp_path / "documents.parquet"))
    assert cp.run(spark, str(tmp_path)).count() == 0


def word_sets(texts, width=5):
    sets = []
    for t in texts:
        w = (t or "").encode().lower().split()
        sets.append({tuple(w[i : i + width]) for i in range(max(1, len(w) - width + 1))})
    return sets


def brute_near_copies(ids, texts, least=0.8):
    sets = word_sets(texts)
    parent = list(range(len(ids)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(ids)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both / len(sets[i] | sets[j]) >= least:
                parent[find(i)] = find(j)
    return sorted({min(ids[j] for j in range(len(ids)) if find(j) == find(i)) for i in range(len(ids))})


def test_near_dedup_stage_equals_brute_force_jaccard(spark, frame, odd):
    import corpus_pipeline as cp

    rng = random.Random(7)
    texts = list(odd)
    for _ in range(30):  # copies with one to eight words changed, some on both sides of 0.8, and their copies
        words = [rng.choice("abcdefghij") + str(rng.randint(0, 300)) for _ in range(rng.randint(60, 150))]
        texts.append(" ".join(words))
        for changes in (1, 2, 3, 4, 8):
            copy = list(words)
            for i in rng.sample(range(len(copy)), changes):
                copy[i] = f"new{rng.random()}"
            texts.append(" ".join(copy))
    kept = [r["doc_id"] for r in cp.drop_near_copies(spark, frame(texts), "").collect()]
    assert sorted(kept) == brute_near_copies(list(range(len(texts))), texts)


def test_near_dedup_stage_of_the_sample_documents(spark, sf):
    import corpus_pipeline as cp

    docs = spark.read.parquet(f"{sf}/documents.parquet")
    rows = docs.collect()
    kept = [r["doc_id"] for r in cp.drop_near_copies(spark, docs, sf).collect()]
    assert sorted(kept) == brute_near_copies([r["doc_id"] for r in rows], [r["text"] for r in rows])


def test_crowded_bands_lose_no_pair(spark, frame, monkeypatch):
    # A chain whose ends are far apart: all meet in two bands, and each is near its neighbours only.
    words = [f"w{i}" for i in range(200)]
    texts = [" ".join(words[8 * k : 8 * k + 100]) for k in range(12)]
    docs = frame(texts).selectExpr("doc_id AS id", "text")
    nodes = similar_texts.sketches(docs, (8, 4)).selectExpr("node", "array(1L, 2L) AS bands", "size", "wide")
    for hot in (3, 4000):
        edges = [tuple(r) for r in similar_texts.links(similar_texts.node_words(docs), nodes, hot=hot).collect()]
        assert len({r["root"] for r in simhash.components(spark.createDataFrame(edges, "u long, v long")).collect()}) == 1


def test_bits_of_similar_sets_differ_as_planned():
    rng = np.random.default_rng(3)
    lanes = similar_texts._lanes(32)
    for n in (50, 100, 400):
        rates = []
        for _ in range(20):
            h = rng.integers(0, 1 << 63, n + n // 8, np.uint64)
            a, b = h[:n], h[n // 8 :]  # similarity 7/9
            rates.append(np.mean(similar_texts.wide_simhash(a, lanes) != similar_texts.wide_simhash(b, lanes)))
        print(n, np.mean(rates), np.std(rates))
        assert np.mean(rates) < similar_texts.FLIP + 0.01


def test_stars_cover_every_row_with_a_near_one():
    rng = np.random.default_rng(9)
    for _ in range(50):
        n = int(rng.integers(2, 40))
        near = np.triu(rng.random((n, n)) < 0.1, 1)
        p, q = np.nonzero(near)
        centre, row = similar_texts.stars(n, p, q)
        assert set(centre) | set(row) == set(p) | set(q) and all(near[min(a, b), max(a, b)] for a, b in zip(centre, row, strict=True))
