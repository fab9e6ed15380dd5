import html
import re

from pyspark.sql import functions as F

from trendlake.functions import nested, text, values


def evaluate(spark, inputs, function):
    rows = [(i, v) for i, v in enumerate(inputs)]
    df = spark.createDataFrame(rows, "i int, x string").select("i", function(F.col("x")).alias("y"))
    return [r.y for r in df.orderBy("i").collect()]


def test_unescape_agrees_with_the_standard_library(spark):
    samples = [
        "caf&eacute; &amp; bar", "&#8217;s", "&#x2019;", "&amp;quot;", "&copy 2020", "&notit; x", "&notin;",
        "&unknown; &", "a & b", "&#0;", "&#128;", "&#150", "&#xD800;", "&#99999999999;", "&#1;", "&#x1F600;",
        "plain", "", "&lt;b&gt;", "&ampamp;", "&#;", "&&amp;&", "&#13;", "&#xFFFE;", "&#x81;", "&NotEqualTilde;",
        "&amp &lt", "&#000000000065;",
    ]
    assert evaluate(spark, samples, text.unescape_html) == [html.unescape(s) for s in samples]


def test_a_quoted_bracket_does_not_end_a_tag(spark):
    samples = ['<a title="x>y">hello</a>', "<a t='>' b>x</a> <p it's>y", '<a t="open>z', "<b " + "a='>' " * 9_000 + ">end"]
    assert evaluate(spark, samples, text.strip_html) == ["hello", "x y", "z", "end"]


def test_strip_html_joins_text_nodes(spark):
    samples = [
        "<p>One <b>two</b>&nbsp;</p><!-- gone --><script>var t='</p>';</script> three",
        "&lt;i&gt;x&lt;/i&gt; a &lt; b", None, "no tags", "<br/><br>", "a<style>p{}</style>b",
    ]
    assert evaluate(spark, samples, text.strip_html) == ["One two three", "x a < b", "", "no tags", "", "a b"]


def test_simple_tag_strip(spark):
    assert evaluate(spark, ["<p>a</p>\n  b ", None, "x<br>y"], text.strip_tags_simple) == ["a b", "", "xy"]


def test_photo_credit(spark):
    samples = [
        "A plated dish. | Jane Doe Smith The room is full.",
        "A plated dish. | Jane doe the room",
        "x" * 301 + " | Jane Doe The room",
        "no pipe", None,
    ]
    expected = [
        s if s is None else re.sub(r"^.{0,300}? \| \S+(?:\s\S+){0,2} (?=[A-Z])", "", s, count=1) for s in samples
    ]
    assert evaluate(spark, samples, text.remove_photo_credit) == expected
    assert expected[0] == "The room is full."


def python_clean(raw, stop):
    """Brute force with the standard library."""
    plain = re.sub(r"https?://\S+|www\.\S+", " ", html.unescape(raw)).lower()
    words = re.sub(r"[^\w\s]", " ", plain).split()
    return " ".join(w for w in words if w not in stop and len(w) > 1 and not w.isdigit())


def test_clean_text_agrees_with_python(spark, sf_dir):
    samples = [
        "The chef&#8217;s table at 6 p.m. &mdash; see https://x.example/a?b=1 now!", "2026 was ² good",
        "CAFÉ éclair naïve", "", "   ", "www.site.org only", "snake_case x1 ٣٤ a",
    ]
    stop = ["the", "at", "was", "of", "new york"]
    assert evaluate(spark, samples, lambda c: text.clean_text(c, stop)) == [python_clean(s, stop) for s in samples]
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rows = docs.select("text", text.clean_text(F.col("text"), stop).alias("clean")).collect()
    assert all(r.clean == python_clean(r.text, stop) for r in rows)


def test_null_text_stays_null(spark):
    assert evaluate(spark, [None], lambda c: text.clean_text(c, [])) == [None]


def test_slug_and_search_name(spark):
    assert evaluate(spark, ["  Foie Gras! ", "Crème"], text.slug) == ["foie_gras", "cr_me"]
    name = evaluate(spark, ["wagyu beef"], lambda c: text.search_name(c, F.lit("vegan|gluten free,x"), F.lit("a,b")))
    assert name == ["wagyu_beef_diet_veganORgluten freeANDx_intol_aANDb"]


def test_default_stop_words_hold_language_and_domain(spark):
    words = text.stop_words(spark)
    assert {"the", "not", "eater", "york"} <= set(words)


def test_published_dates(spark):
    samples = [
        "Tue, 26 May 2026 10:11:12 +0000", "Tue, 26 May 2026 10:11:12 GMT", "2026-05-26T23:11:12-04:00",
        "2026-05-26", "bad", None, "Wed, 6 May 2026 01:00:00 +0200",
    ]
    got = evaluate(spark, samples, lambda c: values.published_date(c).cast("string"))
    assert got == ["2026-05-26", "2026-05-26", "2026-05-27", "2026-05-26", None, None, "2026-05-05"]


def test_numbers_and_labels(spark):
    assert evaluate(spark, ["12", "12.0", "x", None, "12.5"], values.to_int) == [12, 12, None, None, None]
    scores = ["0.05", "0.0499", "-0.05", None]
    labels = evaluate(spark, scores, lambda c: values.sentiment_label(c.cast("double")))
    assert labels == ["positive", "neutral", "negative", "neutral"]
    assert evaluate(spark, ["81", "80", "21", "20"], lambda c: values.severity(c.cast("double"))) == [
        "high", "medium", "medium", "low",
    ]
    assert evaluate(spark, [" a ", None], lambda c: values.default_text(c, "Untitled")) == ["a", "Untitled"]
    assert evaluate(spark, ["2026-02-30", "2026-02-03", "x"], lambda c: values.date_from_name(c).cast("string")) == [
        None, "2026-02-03", None,
    ]


def test_nested_values(spark):
    schema = (
        "ing array<struct<name:string>>, blocks array<struct<steps:array<struct<step:string>>>>, "
        "tags array<string>, a boolean, b boolean"
    )
    rows = [
        ([(" milk ",), ("",), (None,), ("egg",)], [([(" Mix. ",), ("",)],), (None,), ([("Bake.",)],)], ["x", "y"], True, None),
        (None, None, None, False, False),
    ]
    df = spark.createDataFrame(rows, schema)
    got = df.select(
        nested.ingredient_names(F.col("ing")).alias("i"), nested.instruction_text(F.col("blocks")).alias("s"),
        nested.array_to_csv(F.col("tags")).alias("t"), nested.flag_tags({"a": "A", "b": "B"}).alias("f"),
    ).collect()
    assert [tuple(r) for r in got] == [("milk, egg", "Mix. Bake.", "x, y", ["A"]), ("", "", None, [])]
    flat = nested.flatten_arrays(df)
    assert dict(flat.dtypes)["tags"] == "string" and dict(flat.dtypes)["ing"] == "string"
