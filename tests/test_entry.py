"""The registered queries against their SQL, on the smallest tables."""

import duckdb
import pytest

import __spark_entry__ as entry

NAMES = [
    "clean_text", "strip_html", "null_rate", "full_row_duplicates", "outlier_rate_disc", "sentiment_distribution",
    "volume_daily", "top_bigrams", "vector_vocab_filter", "keyword_search_topn", "batch_set_equality", "retention_plan",
]


@pytest.fixture(scope="module")
def database(sf_dir):
    connection = duckdb.connect()
    connection.execute("SET TimeZone = 'UTC'")
    for name in "part orders lineitem events documents embeddings pages labels conversations supplier nation customer".split():
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return connection


def shaped(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])

    def value(v):
        return round(float(v), 9) if isinstance(v, (int, float)) and not isinstance(v, bool) else v

    return sorted(columns), sorted((tuple(value(r[i]) for i in order) for r in rows), key=repr)


def test_every_query_has_sql():
    assert set(entry.REGISTRY) == set(entry.ORACLE) <= set(entry.queries())
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", NAMES)
def test_query_agrees_with_sql(spark, sf_dir, database, name):
    df = entry.queries()[name](spark, sf_dir)
    cursor = database.execute(entry.oracle_sql()[name])
    expected = shaped([d[0] for d in cursor.description], cursor.fetchall())
    assert shaped(df.columns, df.collect()) == expected


def test_flagship(spark):
    assert entry.entry(spark).count() == 7
