from collections import Counter

from pyspark.sql import functions as F

from trendlake.operators import keywords

TEXTS = ["red bolt red", "bolt ring", "", " ", None, "ring ring ring red", "été été red 日本 日本語"] * 30


def test_vocabulary_counts_words_and_documents_within_batches(spark):
    df = spark.createDataFrame([(t,) for t in TEXTS], "body string").repartition(3)
    words = keywords.corpus_words(df, "body")
    rows = keywords.vocabulary(words, 100).collect()
    kept = [t.split() for t in TEXTS if t and t.strip()]
    totals, documents = Counter(w for t in kept for w in t if len(w) > 1), Counter(w for t in kept for w in set(t) if len(w) > 1)
    assert tuple(rows[0]) == ("", len(kept), len(kept))
    assert [(r.term, r.total, r.documents) for r in rows[1:]] == sorted(((w, n, documents[w]) for w, n in totals.items()), key=lambda x: (-x[1], x[0]))
    plan = keywords.vocabulary(words, 100)._jdf.queryExecution().executedPlan().toString()
    assert "Generate" not in plan  # no row for each occurrence
    assert keywords.vocabulary(words.limit(0), 5).count() == 0


def test_whole_words_of_a_short_list_become_the_only_rows(spark):
    rows = [(t, float(i % 5)) for i, t in enumerate(TEXTS)]
    scored = spark.createDataFrame(rows, "body string, compound_score double")
    short = spark.createDataFrame([("red",), ("ring",), ("absent",), ("red",), ("",), (None,)], "term string")
    long = short.union(spark.range(100).select(F.concat(F.lit("none"), "id")))
    got = [sorted(map(tuple, keywords.keyword_means(scored, "body", terms, whole_words=True).collect())) for terms in (short, long)]
    assert got[0] == got[1] and [(r[0], r[2]) for r in got[0]] == [("red", 90), ("ring", 60)]
    plan = keywords.keyword_means(scored, "body", short, whole_words=True)._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan
