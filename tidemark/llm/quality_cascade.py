"""Quality rules as a short-circuit cascade, in DataFrame functions only.

Every rule is a boolean expression that rejects a row. On a sample, written once as a table, the cascade measures each
rule's cost (seconds per row of evaluating it alone, over the columns that it really reads) and its selectivity (share of
rows it rejects), and tests rules in the order of rejections per cost, so that cheap rules that reject much come first and
a rejected row runs no later rule. The sample decides the order and nothing else: the verdict is the conjunction of all
rules, whatever their order. A text is split into words once, for all rules.

Defined cases: null and empty texts have no words, so all counts are 0 and the length rule rejects them; repeated rows get
the same verdict; an empty table keeps the rules in the order of their names; a rule that is null for a row rejects it;
other columns pass through untouched, and one with an output's name as `<name>_input`.
"""

from __future__ import annotations

import time
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import let, set_aside, words_of, written

#: Rows of the sample that orders the rules, of any length.
SAMPLE_ROWS = 1000
METRICS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


@dataclass(frozen=True)
class QualityRule:
    """`rejects` gets the text's words and gives the condition that rejects the row."""

    name: str
    rejects: Callable[[Column], Column]


def word_chars(words: Column) -> Column:
    """Code points inside words."""
    return F.length(F.array_join(words, "")).cast("long")


def n_symbols(text: Column) -> Column:
    return F.length(F.regexp_replace(F.coalesce(text, F.lit("")), r"[^#*$%&|<>]+", "")).cast("long")


def lines_of(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def n_dup_lines(text: Column) -> Column:
    """Lines with a word that equal an earlier line."""
    lines = F.filter(lines_of(text), lambda x: F.regexp_like(x, F.lit(r"[^\x20\x09-\x0D]")))
    return let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long")


def _window_hashes(words: Column, width: int) -> Column:
    return F.transform(F.sequence(F.lit(0), F.size(words) - width), lambda i: F.xxhash64(*(F.get(words, i + k) for k in range(width))))


def _covered(hashes: Column, width: int) -> Column:
    """Sorting (hash, position) pairs puts equal windows side by side, so the work is n log n for any text."""
    pairs = F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i")))
    repeats = let(
        F.array_sort(pairs),
        lambda s: F.filter(s, lambda x, k: (F.get(s, k - 1)["h"].eqNullSafe(x["h"])) | (F.get(s, k + 1)["h"].eqNullSafe(x["h"]))),
    )
    return F.size(F.array_distinct(F.flatten(F.transform(repeats, lambda x: F.array(*(x["i"] + k for k in range(width)))))))


def n_repeat_words(words: Column, width: int = 3) -> Column:
    """Words covered by windows of `width` words that the text holds twice or more, the first one included.

    Windows are compared by a 64-bit hash within one text; only texts with equal windows are sorted.
    """
    covered = let(_window_hashes(words, width), lambda h: F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0)).otherwise(_covered(h, width)))
    return F.when(F.size(words) < width, F.lit(0)).otherwise(covered).cast("long")


def mostly_repeats(words: Column, width: int = 3) -> Column:
    """100 * n_repeat_words > 50 * n_words, without a sort where so few windows repeat that it can't be.

    d windows equal to an earlier one make at most 2 * d windows that repeat, which cover at most 2 * d * width words.
    """
    over = let(
        _window_hashes(words, width),
        lambda h: F.when((F.size(h) - F.size(F.array_distinct(h))) * (4 * width) <= F.size(words), F.lit(False)).otherwise(2 * _covered(h, width) > F.size(words)),
    )
    return F.when(F.size(words) < width, F.lit(False)).otherwise(over)


def with_base_metrics(docs: DataFrame, words: str, text: str = "text") -> DataFrame:
    """Append n_words, word_chars, n_symbols, n_dup_lines and n_repeat_words; the column `words` holds the text's words."""
    c = F.col(text)
    values = (F.size(words).cast("long"), word_chars(F.col(words)), n_symbols(c), n_dup_lines(c), let(F.col(words), lambda w: n_repeat_words(w)))
    return set_aside(docs, *METRICS).withColumns(dict(zip(METRICS, values, strict=True)))


def sampled(docs: DataFrame, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """At most sample_rows rows of docs, written once."""
    total = docs.count()
    return written(docs.sample(min(1.0, 20.0 * sample_rows / max(total, 1)), seed=17).limit(sample_rows), "sample")


def measure_rules(docs: DataFrame, rules: list[QualityRule], words: Column, sample_rows: int = SAMPLE_ROWS) -> list[tuple[QualityRule, float, float]]:
    """(rule, seconds a row, share rejected) on a written sample of at most sample_rows rows; the least time of two runs counts."""
    drawn = sampled(docs, sample_rows)
    rows = drawn.count()
    if not rows:
        return [(r, 1.0, 0.0) for r in rules]

    def timed(c: Column) -> tuple[float, int]:
        best, bad = float("inf"), 0
        for _ in range(2):
            t = time.perf_counter()
            bad = drawn.agg(F.count_if(F.coalesce(c, F.lit(True))).alias("bad")).first()["bad"]
            best = min(best, time.perf_counter() - t)
        return best, bad

    base, _ = timed(let(words, lambda w: F.size(w) < 0))
    times = [(r, *timed(let(words, r.rejects))) for r in rules]
    return [(r, max(s - base, 1e-4) / rows, bad / rows) for r, s, bad in times]


def order_rules(measured: list[tuple[QualityRule, float, float]]) -> list[QualityRule]:
    """By rejections per cost, the best first; ties by cost, then by name."""
    return [r for r, cost, share in sorted(measured, key=lambda x: (-x[2] / x[1], x[1], x[0].name))]


def cascade(docs: DataFrame, rules: list[QualityRule], words: Column, sample_rows: int = SAMPLE_ROWS, drawn: DataFrame | None = None) -> DataFrame:
    """Append `rejected_by`: the first rule of the ordered cascade that rejects the row, null if none does.

    The whole chain is one expression over `words`, which is computed once for all rules of a row, also if a filter on the
    result is pushed below other columns. The sample is drawn from `drawn`, which has the columns that the rules read, or else
    from docs; docs with costly columns would compute them for every row of the table before it is sampled.
    """
    docs = set_aside(docs, "rejected_by")
    ordered = order_rules(measure_rules(docs if drawn is None else drawn, rules, words, sample_rows))

    def chain(w: Column) -> Column:
        found = F.lit(None).cast("string")
        for r in reversed(ordered):
            found = F.when(F.coalesce(r.rejects(w), F.lit(True)), F.lit(r.name)).otherwise(found)
        return found

    return docs.withColumn("rejected_by", let(words, chain))


def base_rules() -> list[QualityRule]:
    return [QualityRule("too_few_words", lambda w: F.size(w) < 50), QualityRule("repeated_windows", lambda w: mostly_repeats(w))]


def content_rules(text: str = "text", known: dict[str, Column] | None = None) -> list[QualityRule]:
    """Rules beyond the base ones, with thresholds far from what running prose has; known has metrics that docs holds already."""
    c, known = F.col(text), known or {}
    n_lines = F.size(lines_of(c))

    def lines(pattern: str) -> Column:
        return F.regexp_count(F.coalesce(c, F.lit("")), F.lit(pattern))

    return [
        QualityRule("symbols", lambda w: known.get("n_symbols", n_symbols(c)) * 10 > F.size(w) * 3),
        QualityRule("duplicate_lines", lambda w: known.get("n_dup_lines", n_dup_lines(c)) * 10 > n_lines * 6),
        QualityRule("word_length", lambda w: let(known.get("word_chars", word_chars(w)), lambda x: (x > F.size(w) * 15) | (x * 10 < F.size(w) * 18))),
        QualityRule("few_letters", lambda w: F.size(F.filter(w, lambda x: F.regexp_like(x, F.lit(r"\p{L}")))) * 10 < F.size(w) * 6),
        QualityRule("cut_off_lines", lambda w: lines(r"(?m)(?:\.\.\.|…)$") * 10 > n_lines * 3),
        QualityRule("bullets", lambda w: lines(r"(?m)^[•*-] ") * 10 > n_lines * 9),
        QualityRule("endless_word", lambda w: F.exists(w, lambda x: F.length(x) > 1000)),
        QualityRule("few_characters", lambda w: F.size(F.array_distinct(F.split(F.coalesce(c, F.lit("")), ""))) < 12),
    ]


def judged(docs: DataFrame, text: str = "text", sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """docs with rejected_by from all rules; each metric is computed only for rows that reach its rule."""
    return cascade(docs, base_rules() + content_rules(text), words_of(F.col(text)), sample_rows)


SQL = r"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS text FROM documents),
w AS (SELECT rid, doc_id, text, [x FOR x IN regexp_split_to_array(text, '[\x20\x09-\x0D]+') IF x <> ''] AS words,
             string_split(text, chr(10)) AS lines FROM d),
m AS (SELECT rid, doc_id, words, len(lines) AS n_lines, len(words)::BIGINT AS n_words,
             length(regexp_replace(text, '[\x20\x09-\x0D]+', '', 'g'))::BIGINT AS word_chars,
             length(regexp_replace(text, '[^#*$%&|<>]+', '', 'g'))::BIGINT AS n_symbols,
             [x FOR x IN lines IF regexp_matches(x, '[^\x20\x09-\x0D]')] AS full_lines,
             len([x FOR x IN words IF regexp_matches(x, '\p{L}')]) AS n_lettered, len([x FOR x IN lines IF ends_with(x, '...') OR ends_with(x, '…')]) AS n_cut,
             len([x FOR x IN lines IF regexp_matches(x, '^[•*-] ')]) AS n_bullets, len([x FOR x IN words IF length(x) > 1000]) AS n_endless,
             len(list_distinct(string_split(text, ''))) AS n_characters FROM w),
g AS (SELECT rid, unnest(range(0, n_words - 2)) AS i FROM m WHERE n_words > 2),
t AS (SELECT g.rid, g.i, m.words[g.i + 1] || ' ' || m.words[g.i + 2] || ' ' || m.words[g.i + 3] AS tri FROM g JOIN m USING (rid)),
r AS (SELECT rid, i FROM t QUALIFY count(*) OVER (PARTITION BY rid, tri) > 1),
c AS (SELECT rid, count(DISTINCT i + k) AS n FROM r, (VALUES (0), (1), (2)) AS o(k) GROUP BY rid),
b AS (SELECT m.doc_id, n_words, word_chars, n_symbols, (len(full_lines) - len(list_distinct(full_lines)))::BIGINT AS n_dup_lines,
             coalesce(c.n, 0)::BIGINT AS n_repeat_words, n_lines, n_lettered, n_cut, n_bullets, n_endless, n_characters FROM m LEFT JOIN c USING (rid)),
f AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM b)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND n_symbols * 10 <= n_words * 3 AND n_dup_lines * 10 <= n_lines * 6
         AND word_chars <= n_words * 15 AND word_chars * 10 >= n_words * 18
         AND n_lettered * 10 >= n_words * 6 AND n_cut * 10 <= n_lines * 3 AND n_bullets * 10 <= n_lines * 9 AND n_endless = 0 AND n_characters >= 12 AS kept
FROM f
"""


def query(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    count = lambda x: with_base_metrics(x.withColumn("words", words_of(F.col("text"))), "words")
    counted = count(docs)
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    rules = [QualityRule("base", lambda w: failed), *content_rules(known={m: F.col(m) for m in METRICS})]
    return cascade(counted, rules, F.col("words"), drawn=count(sampled(docs))).select("doc_id", *METRICS, failed.alias("base_failed"), F.col("rejected_by").isNull().alias("kept"))
