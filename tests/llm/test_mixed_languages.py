"""The pipeline's language stage and texts of several languages."""

import corpus_pipeline as cp


def test_texts_of_several_languages_stay(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    names = [r[0] for r in docs.select("lang").distinct().orderBy("lang").collect()]
    parts = []
    for name in names:
        rows = docs.filter((docs.lang == name) & (docs.n_chars > 2000)).orderBy("doc_id").limit(1).collect()
        parts.append(" ".join(rows[0]["text"].split()[:120]))
    mixed = [" ".join(parts[k] for k in at) for at in ((0, 1), (1, 2), (0, 1, 2), tuple(range(len(parts))))]
    more = spark.createDataFrame([(-1 - i, x, None, "mixed", len(x or "")) for i, x in enumerate([*mixed, "123 456 .", None])], docs.schema)
    kept = [r["doc_id"] for r in cp.identify_language(spark, docs.unionByName(more), sf).select("doc_id").collect()]
    assert {-1, -2, -3, -4} <= set(kept) and not {-5, -6} & set(kept)
    assert len(set(kept)) > 0.9 * docs.count()
