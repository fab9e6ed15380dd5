"""URL filter: host rules first, then a weighted vocabulary of strict and soft terms.

An automaton over all terms (Aho-Corasick) reads each URL once. A hit counts only when
no letter or digit adjoins it, and each different term counts its weight once. A URL whose
weights reach ``LIMIT`` is blocked: a strict term has that weight by itself, soft terms have
a part of it, half of it unless a vocabulary says otherwise, so that several different ones
are needed. A rule that fits the host and the path decides before the vocabulary.

The vocabulary is the short fixed one or a table of (term, weight) of any source
(:func:`read_vocabulary`); every worker holds its automaton, so it has at most ``MOST_TERMS``
terms, and a longer table is refused.

Defined results: a null URL and one without ``://`` have an empty host and path, and so
no rule; a null or empty URL is allowed; equal rows get equal verdicts; only the key and
the URL are read. Terms are compared after A-Z are lower-cased, paths as they are. Of a
vocabulary, null and empty terms and weights that are null or not above zero are left out,
and of a repeated term the greatest weight counts.
"""

from __future__ import annotations

import hashlib
import pickle
from collections.abc import Iterator
from functools import lru_cache

import ahocorasick
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trendlake.llm.exact import ascii_lower

# Fixed values: (action, rule).
RULES = (("block", "net/"), ("allow", "example.net/en/"), ("block", "example.com/de/"), ("allow", "org/fr/"))
STRICT = ("casino", "hentai", "porn", "sex", "viagra", "warez", "xxx")
SOFT = ("adult", "bet", "bonus", "cheap", "credit", "dating", "escort", "free", "loan", "lottery", "nude", "pills", "poker", "slots", "webcam")
MIN_SOFT = 2
LIMIT = 1.0
MOST_TERMS = 1_000_000
VOCABULARY = {**dict.fromkeys(SOFT, LIMIT / MIN_SOFT), **dict.fromkeys(STRICT, LIMIT)}


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host, A-Z lower-cased, and path of a URL; both empty without ``://``."""
    rest = F.when(F.contains(url, F.lit("://")), F.regexp_extract(url, r"(?s)^.*?://(.*)$", 1)).otherwise("")
    rest = F.coalesce(rest, F.lit(""))
    return ascii_lower(F.regexp_extract(rest, r"^[^/?#]*", 0)), F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def fitting_rule(host: Column, path: Column, rules: tuple[tuple[str, str], ...] = RULES) -> Column:
    """The longest rule that fits, as struct (rule, action); null without one."""
    fitted = F.lit(None).cast("struct<rule:string,action:string>")
    for action, rule in sorted(rules, key=lambda r: (len(r[1]), r[1])):  # the last that fits is the longest
        name, slash, start = rule.partition("/")
        fits = ((host == name) | host.endswith(f".{name}")) & path.startswith(slash + start)
        fitted = F.when(fits, F.struct(F.lit(rule).alias("rule"), F.lit(action).alias("action"))).otherwise(fitted)
    return fitted


def read_vocabulary(terms: DataFrame, term: str = "term", weight: str = "weight") -> dict[str, float]:
    """Weights of a table's terms, in lower case (A-Z)."""
    rows = terms.select(ascii_lower(F.col(term)).alias("term"), F.col(weight).cast("double").alias("weight"))
    known = rows.filter((F.col("term") != "") & (F.col("weight") > 0)).groupBy("term").agg(F.max("weight").alias("weight"))
    listed = known.limit(MOST_TERMS + 1).collect()
    if len(listed) > MOST_TERMS:
        raise ValueError(f"a vocabulary may have {MOST_TERMS} terms")
    return {r["term"]: r["weight"] for r in listed}


class Vocabulary:
    """The automaton of a weighted vocabulary."""

    def __init__(self, weights: dict[str, float], limit: float = LIMIT):
        self.machine, self.limit = ahocorasick.Automaton(), limit * (1 - 1e-9)  # weights may be thirds
        for term, weight in weights.items():
            self.machine.add_word(term, (term, weight))
        self.machine.make_automaton()

    def blocks(self, url: str | None) -> bool:
        """Whether the different terms of the URL (its A-Z lower-cased already) reach the limit."""
        if not url or not len(self.machine):
            return False
        hits, total = set(), 0.0
        for end, (term, weight) in self.machine.iter(url):
            before, after = end - len(term), end + 1
            if term in hits or (before >= 0 and url[before].isalnum()) or (after < len(url) and url[after].isalnum()):
                continue
            hits.add(term)
            total += weight
            if total >= self.limit:
                return True
        return False


@lru_cache(maxsize=2)
def _held(number: str, packed: bytes, limit: float) -> Vocabulary:
    return Vocabulary(pickle.loads(packed), limit)


def judge_urls(
    pages: DataFrame, key: str = "page_id", url: str = "url", rules: tuple[tuple[str, str], ...] = RULES,
    vocabulary: dict[str, float] | None = None, limit: float = LIMIT,
) -> DataFrame:
    """(key, host, path, rule, verdict) of every row."""
    host, path = host_and_path(F.col(url))
    rows = pages.select(F.col(key).alias("key"), F.col(url).alias("url"), host.alias("host"), path.alias("path"))
    rows = rows.withColumn("fit", fitting_rule(F.col("host"), F.col("path"), rules))
    rows = rows.select("key", ascii_lower(F.col("url")).alias("low"), "host", "path", F.col("fit.rule"), F.col("fit.action"))

    packed = pickle.dumps(VOCABULARY if vocabulary is None else vocabulary)
    shared, number = pages.sparkSession.sparkContext.broadcast(packed), hashlib.sha256(packed).hexdigest()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = _held(number, shared.value, limit)  # built once a worker
        for batch in batches:
            verdicts = [
                action or ("block" if words.blocks(low) else "allow")
                for low, action in zip(batch.column("low").to_pylist(), batch.column("action").to_pylist(), strict=True)
            ]
            columns = [batch.column(c) for c in ("key", "host", "path", "rule")]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(verdicts, pa.string())], [key, "host", "path", "rule", "verdict"])

    kind = pages.schema[key].dataType.simpleString()
    return rows.mapInArrow(run, f"`{key}` {kind}, host string, path string, rule string, verdict string")
