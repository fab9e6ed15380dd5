import json
import os
from datetime import date

import pytest
from pyspark.sql import functions as F

from trendlake.sources import batches, drift, landed, partitions, sinks

RECIPE = {
    "id": 1, "title": "Bowl", "preparationMinutes": None, "license": 5, "vegan": True, "healthScore": 3.5,
    "summary": "A <b>bowl</b> &amp; more", "cuisines": ["Asian", "Thai"],
    "extendedIngredients": [{"name": "rice", "measures": {"us": {"amount": 1.0}}}, {"name": None}],
    "analyzedInstructions": [{"name": "", "steps": [{"number": 1, "step": "Boil.", "length": {"number": 2, "unit": "min"}}]}],
}


def test_recipe_files(spark, tmp_path):
    (tmp_path / "a.json").write_text(json.dumps({"results": [RECIPE], "totalResults": 1}, indent=1))
    (tmp_path / "b.json").write_text(json.dumps({"results": [{**RECIPE, "license": "CC", "preparationMinutes": "x"}]}))
    (tmp_path / "c.json").write_text(json.dumps({"results": [], "totalResults": 0}))
    rows = landed.read_recipes(spark, str(tmp_path)).orderBy("_source_file").collect()
    assert [(r.id, r.license, r._source_file.split("/")[-1]) for r in rows] == [(1, "5", "a.json"), (1, "CC", "b.json")]
    assert rows[0].extendedIngredients[0].measures.us.amount == 1.0


def test_article_files(spark, tmp_path):
    articles = [{"article_id": "1", "article_title": "x", "categories": ["a"]}, {"article_id": "2", "categories": []}]
    (tmp_path / "one.json").write_text(json.dumps(articles))
    rows = landed.read_articles(spark, str(tmp_path)).orderBy("_position").collect()
    assert [(r.article_id, r._source_file.split("/")[-1]) for r in rows] == [("1", "one.json"), ("2", "one.json")]


RSS_ITEM = (
    "<item><title>{t}</title><link>http://x/{t}</link><guid isPermaLink='false'>g{t}</guid>"
    "<dc:creator>Ann</dc:creator><pubDate>Tue, 26 May 2026 10:11:12 +0000</pubDate>"
    "<description>short</description><content:encoded><![CDATA[<p>Long &amp; <b>rich</b></p>]]></content:encoded>"
    "<category>Food</category><category> News </category></item>"
)


def test_rss_items_and_cap(spark, tmp_path):
    items = "".join(RSS_ITEM.format(t=i) for i in range(25))
    bare = "<item><link>http://y</link><description>only</description></item>"
    head = '<rss xmlns:dc="http://purl.org/dc/elements/1.1/" xmlns:content="http://purl.org/rss/1.0/modules/content/">'
    (tmp_path / "feed.xml").write_text(f"<?xml version='1.0'?>{head}<channel>{items}</channel></rss>")
    (tmp_path / "bare.xml").write_text(f"<?xml version='1.0'?>{head}<channel>{bare}</channel></rss>")
    rows = landed.read_rss(spark, str(tmp_path), "feed (RSS)", F.lit("20260527"))
    capped = landed.cap_per_feed(rows).collect()
    full = [r for r in capped if r.author == "Ann"]
    assert sorted(int(r.article_title) for r in full) == list(range(20))
    first = next(r for r in full if r.article_title == "0")
    assert (first.article_id, first.article_summary, first.categories) == ("g0", "Long &amp; rich", ["Food", "News"])
    other = next(r for r in capped if r.author == "")
    assert (other.article_title, other.article_summary, other.categories) == ("Untitled", "only", [])
    assert rows.columns[:10] == [
        "source", "article_title", "article_url", "article_id", "author", "article_summary", "categories",
        "location_focus", "published_date", "date_extracted",
    ]


def test_atom_entries(spark, tmp_path):
    entry = (
        "<entry><title>T</title><id>i1</id><author><name>Bo</name></author><updated>2026-05-26T10:00:00-04:00</updated>"
        "<link rel='self' href='http://self'/><link rel='alternate' href='http://alt'/>"
        "<content type='html'>&lt;p&gt;Body&lt;/p&gt;</content><category term='Food'/></entry>"
    )
    second = "<entry><id>i2</id><published>2026-05-25</published><link href='http://plain'/><summary>S</summary></entry>"
    (tmp_path / "atom.xml").write_text(f"<feed xmlns='http://www.w3.org/2005/Atom'>{entry}{second}</feed>")
    rows = {r.article_id: r for r in landed.read_atom(spark, str(tmp_path), "feed (Atom)", F.lit("t")).collect()}
    assert (rows["i1"].article_url, rows["i1"].article_summary, rows["i1"].author) == ("http://alt", "Body", "Bo")
    assert rows["i1"].published_date == "2026-05-26T10:00:00-04:00" and rows["i1"].categories == ["Food"]
    assert (rows["i2"].article_url, rows["i2"].article_title, rows["i2"].article_summary) == ("http://plain", "Untitled", "S")


def test_drifted_parquet(spark, tmp_path):
    for i in range(4):
        df = spark.createDataFrame([(i, i if i % 2 else f"CC {i}")], f"id int, license {'int' if i % 2 else 'string'}")
        df = df.withColumn("description", F.lit("d")) if i == 3 else df
        df.coalesce(1).write.parquet(str(tmp_path / f"f{i}"))
    files = [r.path for r in partitions.file_listing(spark, str(tmp_path), "*.parquet").collect()]
    assert sorted(len(g) for g in drift.schema_groups(spark, sorted(files))) == [2, 2]
    rows = drift.read_reconciled(spark, files).orderBy("id").collect()
    assert [(r.id, r.license, r.description) for r in rows] == [(0, "CC 0", None), (1, "1", None), (2, "CC 2", None), (3, "3", "d")]
    with pytest.raises(FileNotFoundError):
        drift.read_reconciled(spark, [])


def test_dated_tables(spark, tmp_path):
    base = str(tmp_path / "t")
    df = spark.range(5).select(F.col("id").cast("int"))
    assert sinks.write_dated(df, base, date(2026, 5, 1)) == 5
    assert sinks.write_dated(df.limit(2), base, date(2026, 5, 2), small=True) == 2
    assert sinks.write_dated(df.limit(3), base, date(2026, 5, 2)) == 3
    assert spark.read.parquet(base).count() == 8
    assert partitions.latest_partition_date(spark, base) == "2026-05-02"
    assert partitions.latest_partition_path(spark, base).endswith("dt=2026-05-02")
    assert partitions.newest(spark.read.parquet(base), "dt").count() == 3
    assert partitions.read_history(spark, base).count() == 8
    absent = str(tmp_path / "absent")
    assert partitions.latest_partition_path(spark, absent) == absent
    with pytest.raises(FileNotFoundError):
        partitions.latest_partition_path(spark, absent, required=True)
    published = sinks.publish_latest(spark, str(tmp_path), str(tmp_path / "out"), ["t", "none"]).collect()
    assert [tuple(r) for r in published] == [("t", "2026-05-02", 3)]
    assert spark.read.parquet(str(tmp_path / "out" / "t")).count() == 3


def test_inventory_and_freshness(spark, tmp_path):
    for day, name in (("2026-05-01", "a"), ("2026-05-02", "b"), ("2026-05-02", "c")):
        folder = tmp_path / "api" / day
        folder.mkdir(parents=True, exist_ok=True)
        (folder / f"{name}.json").write_text("{}")
    files = partitions.source_listing(spark, {"api": str(tmp_path / "api"), "web": str(tmp_path / "web")}, "*.json")
    row = partitions.inventory(files).collect()
    assert [(r.source, r.distinct_dates, r.files, r.latest_files, r.dates) for r in row] == [
        ("api", 2, 3, 2, ["2026-05-01", "2026-05-02"])
    ]
    assert partitions.latest_file(files, by="name").first().name == "c.json"
    assert str(partitions.freshness(files).first().partition_date) == "2026-05-02"
    assert partitions.distinct_paths(files.union(files)).count() == 3


def test_retention(spark, tmp_path):
    for name in ("dt=2026-04-26", "2026-04-27", "2026-05-20", "2026-02-31", "other"):
        (tmp_path / name).mkdir()
    today = date(2026, 5, 27)
    plan = partitions.apply_retention(spark, [str(tmp_path)], today, dry_run=True).collect()
    status = {str(r.dt): r.status for r in plan}
    assert status == {"2026-04-26": "deleted", "2026-04-27": "kept", "2026-05-20": "kept"}
    assert (tmp_path / "dt=2026-04-26").exists()
    partitions.apply_retention(spark, [str(tmp_path)], today)
    assert sorted(os.listdir(tmp_path)) == ["2026-02-31", "2026-04-27", "2026-05-20", "other"]


def test_repeated_batches(spark):
    def rows(batch, ids, day="d1"):
        return [(day, batch, i) for i in ids]

    schema = "day string, batch string, id string"
    stored = spark.createDataFrame(rows("s1", ["a", "b", None]) + rows("s2", ["a"]) + rows("s3", ["q"], "d2"), schema)
    new = spark.createDataFrame(
        rows("n1", ["b", None, "a", "a"]) + rows("n2", ["a", "b"]) + rows("n3", ["a", "null"]) + rows("n4", ["q"]), schema
    )
    repeated = batches.repeated_batches(new, stored, "batch", "day", "id").collect()
    assert [tuple(r) for r in repeated] == [("d1", "n1")]
    kept = batches.skip_repeated_batches(new, stored, "batch", "day", "id")
    assert kept.columns == ["day", "batch", "id"] and {r.batch for r in kept.collect()} == {"n2", "n3", "n4"}


def test_json_sink(spark, tmp_path):
    sinks.write_json(spark.createDataFrame([(1, ["a"])], "id int, tags array<string>"), str(tmp_path / "j"), date(2026, 5, 1))
    assert spark.read.json(str(tmp_path / "j")).first().tags == ["a"]


def test_readers_see_committed_runs_only(spark, tmp_path):
    target = str(tmp_path / "published")
    with pytest.raises(FileNotFoundError):
        sinks.read_published(spark, target, "a")
    first = sinks.publish_snapshot(spark, {"a": spark.range(3), "b": spark.range(2)}, target)
    late = sinks.new_run()
    staged = sinks.stage_snapshot({"a": spark.range(9), "b": spark.range(8)}, target, late)  # a run that stopped here
    assert [sinks.read_published(spark, target, t).count() for t in "ab"] == [3, 2] and staged == {"a": 9, "b": 8}
    sinks.commit_snapshot(spark, target, late, staged)
    assert [sinks.read_published(spark, target, t).count() for t in "ab"] == [9, 8]
    assert sinks.read_published(spark, target, "a", first).count() == 3
    with pytest.raises(FileNotFoundError):
        sinks.read_published(spark, target, "c")
    assert sinks.published_runs(spark, target) == [first, late]
    assert sinks.drop_old_runs(spark, target, keep=1) == [first] and sinks.published_runs(spark, target) == [late]
    assert sinks.read_published(spark, target, "a").count() == 9


def test_newest_day_of_each_source(spark):
    rows = [("a", date(2026, 5, 1), "x"), ("a", date(2026, 5, 2), "y"), ("a", date(2026, 5, 2), "z"), ("b", date(2026, 4, 1), "w"), ("c", None, "v"), (None, date(2026, 1, 1), "u")]
    got = partitions.newest_of_each(spark.createDataFrame(rows, "source string, dt date, path string"))
    assert sorted(r.path for r in got.collect()) == ["u", "w", "y", "z"]


def test_table_summary_counts_tables_and_files_without_rows(spark, tmp_path):
    spark.range(10).repartition(2).write.parquet(str(tmp_path / "two"))
    spark.range(0).coalesce(1).write.parquet(str(tmp_path / "none"))
    spark.range(0).coalesce(1).write.mode("append").parquet(str(tmp_path / "two"))
    tables = {name: spark.read.parquet(str(tmp_path / name)) for name in ("two", "none")}
    from trendlake.sources.partitions import table_summary

    assert {r["table"]: (r["rows"], r["files"]) for r in table_summary(tables).collect()} == {"two": (10, 3), "none": (0, 1)}
