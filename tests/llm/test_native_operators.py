"""URL filters and the quality cascade."""

import random

import pytest
from oracle import check
from pyspark.sql import functions as F

from tidemark.llm import quality_cascade as qc
from tidemark.llm import url_filter as uf
from tidemark.llm.common import words_of


@pytest.mark.parametrize("module", [uf, qc])
def test_query_agrees_with_its_sql(spark, sf, module):
    check(spark, sf, module.query, module.SQL)


URLS = [
    ("http://example.com/en/7x", "example.com", "/en/7x", "example.com/en/7", "allow"),
    ("https://A.Example.COM/en/8?x#y", "a.example.com", "/en/8", "com/en/", "block"),
    ("http://com/en/", "com", "/en/", "com/en/", "block"),
    ("http://notexample.com/en/7", "notexample.com", "/en/7", "com/en/", "block"),
    ("http://example.net/de/80", "example.net", "/de/80", "example.net/de/8", "block"),
    ("http://x.net/de/8", "x.net", "/de/8", "net/de/", "allow"),
    ("http://x.net/DE/8", "x.net", "/DE/8", None, "allow"),
    ("http://x.net/en", "x.net", "/en", None, "allow"),
    ("http://x.com?/en/", "x.com", "", None, "allow"),
    ("x.com/en/", "", "", None, "allow"),
    (None, "", "", None, "allow"),
    ("", "", "", None, "allow"),
    ("a://b://org/es/", "b:", "//org/es/", None, "allow"),
    ("x://\u00c9.org/es/\n9", "\u00c9.org", "/es/\n9", "org/es/", "block"),
]


def test_urls_by_hand(spark):
    df = spark.createDataFrame([(u, "kept") for u, *_ in URLS] * 2, "url string, `other` string")
    table = spark.createDataFrame([(r.verdict, r.host, r.path) for r in uf.RULES], "verdict string, host string, path string")
    by_table = {r["url"]: (r["host"], r["path"], r["rule"], r["verdict"]) for r in uf.filter_urls(df, table).collect()}
    assert by_table == {u: tuple(x) for u, *x in URLS}
    got = uf.filter_urls(df, uf.RULES)
    rows = {r["url"]: (r["host"], r["path"], r["rule"], r["verdict"]) for r in got.collect()}
    assert rows == {u: tuple(x) for u, *x in URLS}
    assert got.count() == 2 * len(URLS) and "other" in got.columns


def test_url_filter_edge_cases(spark):
    df = spark.createDataFrame([("http://a.b/c",)], "url string")
    assert uf.filter_urls(df.limit(0), uf.RULES).count() == 0
    assert uf.filter_urls(df, [], default="block").first()["verdict"] == "block"
    clash = uf.filter_urls(df.withColumn("Rule", F.lit(1)).withColumn("_fit", F.lit(2)), uf.RULES)
    assert clash.columns == ["url", "Rule_input", "_fit", "host", "path", "rule", "verdict"]
    assert tuple(clash.first()) == ("http://a.b/c", 1, 2, "a.b", "/c", None, "allow")
    with pytest.raises(ValueError):
        uf.parse_rule("maybe x")
    hosts = uf.filter_urls(spark.createDataFrame([("http://b",), ("http://x.b/q",), ("http://bb/q",)], "url string"), [uf.parse_rule("block b")])
    assert sorted((r["host"], r["verdict"]) for r in hosts.collect()) == [("b", "block"), ("bb", "allow"), ("x.b", "block")]


def test_url_rules_agree_with_brute_force(spark, monkeypatch):
    rng = random.Random(4)
    word = lambda: "".join(rng.choice("ab1-") for _ in range(rng.randint(1, 2)))
    rules = list({uf.UrlRule(rng.choice(uf.VERDICTS), ".".join(word() for _ in range(rng.randint(1, 2))), rng.choice(["", "/" + word(), "/" + word() + "/"])).name: None for _ in range(60)})
    rules = [uf.UrlRule("block", *x) for x in ((r.partition("/")[0], r[len(r.partition("/")[0]) :]) for r in rules)]
    urls = ["http://" + ".".join(word() for _ in range(rng.randint(1, 3))) + rng.choice(["", "/"]) + word() + "/" + word() for _ in range(300)]

    def plain(u):
        host, slash, path = u[7:].partition("/")
        fits = [r for r in rules if (host == r.host or host.endswith("." + r.host)) and (slash + path).startswith(r.path)]
        return max(map(lambda r: (len(r.name), r.name), fits), default=(0, None))[1]

    frame = spark.createDataFrame([(u,) for u in urls], "url string")
    table = spark.createDataFrame([(r.verdict, r.host, r.path) for r in [*rules, uf.UrlRule("block", "-", "")]], "verdict string, host string, path string")
    for how in (rules, table):
        assert {r["url"]: r["rule"] for r in uf.filter_urls(frame, how).collect()} == {u: plain(u) for u in urls}
    monkeypatch.setattr(uf, "LITERAL_RULES", 3)
    assert {r["url"]: r["rule"] for r in uf.filter_urls(frame, rules).collect()} == {u: plain(u) for u in urls}


def with_words(df):
    return df.withColumn("_w", words_of(F.col("text")))


def test_quality_counts_of_odd_texts(spark, frame, odd):
    df = frame([*odd, "a b c a b c d", "# $ x\n# $ x\n\n\n# $ x"], words="extra", N_words="x")
    counted = qc.with_base_metrics(with_words(df), "_w")
    got = {r["doc_id"]: r for r in counted.collect()}
    assert [got[i]["n_words"] for i in (0, 1, 2)] == [0, 0, 0] and {r["N_words_input"] for r in got.values()} == {"x"}
    assert got[7]["word_chars"] == 5000 and got[8]["n_repeat_words"] == 3000
    a, b = got[len(odd)], got[len(odd) + 1]
    assert (a["n_words"], a["n_repeat_words"]) == (7, 6)
    assert (b["n_symbols"], b["n_dup_lines"], b["n_repeat_words"]) == (6, 2, 9)


def test_the_bound_of_mostly_repeats_is_exact(spark, frame):
    rng = random.Random(2)
    texts = [" ".join(rng.choice("abcdefghijklmnopqrstuvwxyz"[:n]) for _ in range(rng.randint(0, 80))) for n in (2, 4, 6, 9, 12, 26) for _ in range(60)]
    for r in with_words(frame(texts)).select(qc.n_repeat_words(F.col("_w")).alias("n"), qc.mostly_repeats(F.col("_w")).alias("over"), F.size("_w").alias("words")).collect():
        assert r["over"] == (100 * r["n"] > 50 * r["words"])


def test_cascade_verdict_does_not_depend_on_order(spark, frame, odd):
    texts = [*odd, "word " * 60, " ".join(f"w{i} and" for i in range(60)), "## " + "| word " * 60]
    df = frame(texts, rejected_BY="mine", _words="yours")
    rules = qc.base_rules() + qc.content_rules()
    forward = {r["doc_id"]: r["rejected_by"] is None for r in qc.cascade(with_words(df), rules, F.col("_w")).collect()}
    chain = F.coalesce(*(F.when(F.coalesce(r.rejects(F.col("_w")), F.lit(True)), F.lit(r.name)) for r in rules[::-1]))
    assert forward == {r["doc_id"]: r["x"] is None for r in with_words(df).withColumn("x", chain).collect()}
    assert forward[len(odd) + 1] and not forward[len(odd)]
    judged = qc.judged(df)
    assert {r["doc_id"]: r["rejected_by"] is None for r in judged.collect()} == forward
    assert judged.columns == ["doc_id", "text", "rejected_BY_input", "_words", "rejected_by"]
    assert {(r["rejected_BY_input"], r["_words"]) for r in judged.collect()} == {("mine", "yours")}
    assert qc.judged(df.limit(0)).count() == 0
    assert qc.cascade(df, [], words_of(F.col("text"))).filter("rejected_by IS NULL").count() == df.count()


def test_a_rejected_row_runs_no_later_rule(spark, frame, monkeypatch):
    broken = qc.QualityRule("z", lambda w: F.raise_error(F.lit("must not run")).isNotNull())
    measured = [(broken, 1.0, 0.0), (qc.QualityRule("a", lambda w: F.lit(True)), 1.0, 0.5)]
    monkeypatch.setattr(qc, "measure_rules", lambda *args: measured)
    found = qc.judged(frame(["a", None]))
    assert {r["rejected_by"] for r in found.collect()} == {"a"} and found.filter("rejected_by IS NULL").count() == 0


def test_a_filter_on_the_verdict_splits_each_text_once(spark, frame):
    import time

    df = frame([" ".join(f"w{i}" for i in range(60_000))] * 4)
    t = time.perf_counter()
    assert qc.judged(df).filter("rejected_by IS NULL").count() == 4
    assert time.perf_counter() - t < 60


@pytest.mark.parametrize(("text", "rule"), [("ab " * 30 + "!? " * 40, "few_letters"), ("\n".join(f"line {i} goes on..." for i in range(20)), "cut_off_lines"), ("\n".join(f"- item {chr(97 + i)}" for i in range(26)), "bullets"), ("x" * 1001 + " of them", "endless_word"), ("ab ba", "few_characters"), ("### a", "symbols"), ("one line\n" * 9, "duplicate_lines"), ("a b c", "word_length")])
def test_content_rules_one_by_one(spark, frame, text, rule):
    rejects = {r.name: r.rejects for r in qc.content_rules()}[rule]
    plain = "Running prose of ordinary words stays.\nIt has lines, and each of them ends like a sentence."
    assert [r["x"] for r in with_words(frame([text, plain])).orderBy("doc_id").select(rejects(F.col("_w")).alias("x")).collect()] == [True, False]


def test_rules_are_ordered_by_rejection_per_cost():
    a, b, c = (qc.QualityRule(x, None) for x in "abc")
    assert [r.name for r in qc.order_rules([(a, 1.0, 0.5), (b, 0.1, 0.1), (c, 1.0, 0.0)])] == ["b", "a", "c"]


def test_metrics_are_not_computed_for_rows_outside_the_sample(spark, sf, monkeypatch):
    from tidemark.llm import quality_cascade as qc

    seen = []
    monkeypatch.setattr(qc, "measure_rules", lambda docs, rules, words, rows=qc.SAMPLE_ROWS: seen.append(docs.inputFiles()) or [(r, 1.0, 0.0) for r in rules])
    qc.query(spark, sf)
    assert seen and all("documents.parquet" not in f for f in seen[0])
