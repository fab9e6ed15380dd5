import hashlib
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from trendlake.llm import classifier, pseudonyms

KEY = "k"


def test_values_are_found_validated_and_reversible(spark):
    texts = [
        "mail bosbt.42@mail8.example.com. +1 (416) 555-4060, 15.254.31.141 and 4077922580886963 4077-9225-8088-6963",
        "2024-02-29 02/29/2024 31/12/1999 29.02.2024; 123-45-6789 +44 20 7946 0958 a@b.c", None, "", "plain",
        "1.2.3 2024-13-01 2023-02-29 4077922580886964 999.1.1.1 000-12-3456 13/13/2000", "x" * 200_000 + " 15.254.31.141", "15.254.31.141", "15.254.31.141",
    ]
    docs = spark.createDataFrame([(i, t, "clash") for i, t in enumerate(texts)], "doc_id long, text string, done string")
    rows = {r.doc_id: r for r in pseudonyms.replace_personal(docs, KEY).collect()}
    counts = [tuple(rows[i][f"n_{k}"] for k in pseudonyms.KINDS) for i in range(len(texts))]
    assert counts[:2] == [(1, 0, 1, 0, 2, 1), (1, 4, 0, 1, 0, 1)] and set(counts[2:6]) == {(0,) * 6}
    assert [rows[i].text for i in range(2, 6)] == texts[2:6] and rows[7].text == rows[8].text == rows[6].text.split()[-1]
    for old in re.findall(r"\S*\d\S*", texts[0] + " " + texts[1]):
        assert len(old) < 5 or old not in rows[0].text + rows[1].text
    back = spark.createDataFrame([(i, r.text) for i, r in rows.items()], "doc_id long, text string")
    assert {r.doc_id: r.text for r in pseudonyms.replace_personal(back, KEY, back=True).collect()} == dict(enumerate(texts))
    again = pseudonyms.replace_personal(back, KEY).collect()  # pseudonyms are valid values of their kind
    assert [tuple(r[f"n_{k}"] for k in pseudonyms.KINDS) for r in sorted(again)] == counts
    assert pseudonyms.replace_personal(docs, "other").filter("doc_id = 7").first().text != rows[7].text
    assert pseudonyms.replace_personal(docs.limit(0), KEY).collect() == []


def test_numbers_beside_a_value_do_not_hide_or_change_it(spark):
    card, dashed, amex, phone = "4111 1111 1111 1111", "4111-1111-1111-1111", "3782 822463 10005", "+44 20 7946 0958"
    odd, home = "41111111 11111111", "416-555-4060"
    long = next(f"6212 3456 7890 1235 {n}" for n in range(100, 999) if luhn(f"6212345678901235{n}"))
    assert not luhn("6212345678901235")
    values = {"c": card, "d": dashed, "a": amex, "p": phone, "o": odd, "l": long, "h": home, "x": long.replace(" ", "")}
    texts = [
        "{c} 12/27", "{c} 123", "{c} 123.", "27 {c}", "{c} {d} {a} 1234", "{c} 416 555 4060 {c}", "{a} 12/27", "{o} 12/27", "{l} 12/27", "{x}", "{d} 123",
        "{p} 12:30", "{p} 12/27", "{p} 12.50", "{p}, {p} 2024-02-29", "{p} {c}", "{p} {h}", "{c} {h}", "{h} {c}", "{p} 10.0.0.1", "{p}.", "{c} 123-45-6789",
        "{l}", "{c} 10.0.0.1", "{p} {c} {c} 12/27", "{p} {d} {a}",
    ]
    docs = spark.createDataFrame([(i, t.format(**values)) for i, t in enumerate([*texts, *(f"{{{k}}}" for k in values)])], "doc_id long, text string")
    rows = pseudonyms.replace_personal(docs, KEY).sort("doc_id").collect()
    own = dict(zip(values, (r.text for r in rows[len(texts) :]), strict=True))
    assert all(own[k] != v for k, v in values.items()) and own["l"].replace(" ", "") == own["x"]
    plain = {"2024-02-29": "n_date", "123-45-6789": "n_ssn", "10.0.0.1": "n_ip", "416 555 4060": "n_phone"}
    for text, r in zip(texts, rows, strict=False):
        for other, count in plain.items():
            assert (other in text) == (r[count] > sum(text.count(f"{{{k}}}") for k in "ph" if count == "n_phone")), text
        pattern = re.escape(text.format(**{k: f"<{k}>" for k in values}))
        for other in plain:
            pattern = pattern.replace(re.escape(other), r"[\d. -]+")
        for k in values:
            pattern = pattern.replace(f"<{k}>", re.escape(own[k]))
        assert re.fullmatch(pattern, r.text), (text, r.text)
    made = spark.createDataFrame([(r.doc_id, r.text) for r in rows], "doc_id long, text string")
    assert pseudonyms.replace_personal(made, KEY, back=True).sort("doc_id").select("text").collect() == docs.sort("doc_id").select("text").collect()


def luhn(digits):
    return sum(int(d) if i % 2 == 0 else sum(map(int, str(2 * int(d)))) for i, d in enumerate(reversed(digits))) % 10 == 0


def brute_feistel(kind, left, right, a, b):
    for turn in range(pseudonyms.ROUNDS):
        keyed = int(hashlib.sha256(f"{KEY}|{kind}|{turn}|{right}".encode()).hexdigest()[:14], 16)
        left, right, a, b = right, (left + keyed) % a, b, a
    return left, right


@pytest.mark.parametrize(("a", "b"), [(7, 9), (16, 16), (1, 5)])
def test_feistel_is_a_permutation_and_equals_brute_force(spark, a, b):
    pairs = spark.range(a * b).select((F.col("id") / b).cast("long").alias("l"), (F.col("id") % b).alias("r"))
    made = pairs.select("l", "r", pseudonyms.feistel(KEY, "t", F.col("l"), F.col("r"), a, b).alias("p"))
    back = made.withColumn("q", pseudonyms.feistel(KEY, "t", F.col("p.l"), F.col("p.r"), a, b, back=True)).collect()
    assert {(r.p.l, r.p.r) for r in back} == {(x, y) for x in range(a) for y in range(b)}
    assert all((r.q.l, r.q.r) == (r.l, r.r) and (r.p.l, r.p.r) == brute_feistel("t", r.l, r.r, a, b) for r in back)


def test_days_and_numbers_stay_in_their_format(spark):
    days = spark.range(2_000).select(F.date_add(F.lit("1800-01-01").cast("date"), (F.col("id") * 73).cast("int")).alias("d"))
    shapes = days.select(*(F.date_format("d", p).alias(f"c{i}") for i, p in enumerate(("yyyy-MM-dd", "MM/dd/yyyy", "dd.MM.yyyy"))))
    for column in shapes.columns:
        made = shapes.select(column, pseudonyms._date(KEY, F.col(column), False).alias("p")).collect()
        assert len({r.p for r in made}) == len(made) and all(re.sub(r"\d", "9", r.p) == re.sub(r"\d", "9", r[column]) for r in made)
    phones = spark.range(3_000).select(F.format_string("(%d) %d-%04d", F.col("id") % 800 + 200, F.col("id") % 700 + 250, F.col("id")).alias("v"))
    made = phones.select(pseudonyms._phone(KEY, F.col("v"), False).alias("p")).collect()
    assert len({r.p for r in made}) == 3_000 and all(re.fullmatch(r"\([2-9]\d\d\) [2-9]\d\d-\d{4}", r.p) for r in made)


def test_no_python_on_the_path(spark):
    docs = spark.createDataFrame([(1, "a")], "doc_id long, text string")
    plan = pseudonyms.replace_personal(docs, KEY)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and plan.count("regexp_extract_all") == 1


def test_classifier_on_held_out_rows(spark, sf_dir):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "labels"))
    odd = spark.createDataFrame([(10**9, None), (10**9 + 1, ""), (10**9 + 2, "!!! " * 40_000), (None, "no key")], "doc_id long, text string")
    docs = docs.select("doc_id", "text").unionByName(odd).withColumn("score", F.lit("clash"))
    rows = classifier.score(docs, classifier.fit(docs, labels)).join(labels, "doc_id", "left").collect()
    assert len(rows) == docs.count() and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in rows)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows if r.doc_id is not None)
    tested = [r for r in rows if r.held_out and r.quality is not None]
    assert sum(r.predicted == r.quality for r in tested) >= 0.95 * len(tested) > 50


def test_scores_do_not_depend_on_held_out_labels_or_on_labels_at_all(spark):
    docs = spark.createDataFrame([(i, f"text {i} " * 60) for i in range(30)], "doc_id long, text string")
    labels = [(i, i % 2) for i in range(30)]
    own = classifier.fit(docs, spark.createDataFrame(labels, "doc_id long, quality int"))
    turned = [(i, 1 - q if zlib.crc32(str(i).encode()) % 5 == 0 else q) for i, q in labels] + [(None, 1), (3, None)]
    assert np.array_equal(own, classifier.fit(docs, spark.createDataFrame(turned, "doc_id long, quality int")))
    none = classifier.fit(docs, spark.createDataFrame([], "doc_id long, quality int"))
    assert not none.any() and {r.score for r in classifier.score(docs, none).collect()} == {0.5}
    assert classifier.score(docs.limit(0), own).collect() == []


def test_ftrl_separates_and_is_sparse():
    import pyarrow as pa

    good, bad = [f"alpha beta w{i} gamma" for i in range(60)], [f"SPAM!! W{i}!! spam##" for i in range(60)]
    weights = classifier.fit_rows(pa.array([t for p in zip(good, bad, strict=True) for t in p]), np.array([1, 0] * 60), epochs=5)
    made = classifier.scores(weights, pa.array(["alpha new gamma beta", "NEW!! SPAM!! x##", "", " "]))
    assert made[0] > 0.6 > 0.4 > made[1] and made[2] == made[3]
    assert (weights != 0).mean() < 0.01


def test_shapes_read_whole_words():
    assert classifier.shape("a1" * 150 + "!!!7") == "x0" * 150 + "!!0"
    assert classifier.shape("x" * 100_000 + "9") == "x0"
