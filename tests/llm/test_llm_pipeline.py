import random
import re
from collections import Counter

import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from trendlake.llm import bpe

WORD = re.compile(r"[^\x20\x09-\x0D]+")
UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, row string, kept string, size string"


def rows():
    rng = random.Random(5)
    out = []
    for group in range(25):
        base = [f"{rng.choice('abcdefgh')}{rng.randrange(900)}" for _ in range(rng.randint(55, 120))]
        for _ in range(rng.choice((1, 1, 2, 5))):
            own = list(base)
            for _ in range(rng.choice((0, 0, 1, 12))):
                own[rng.randrange(len(own))] = "edited"
            text = " ".join(own)
            out.append(text.upper() if rng.random() < 0.2 else text)
    out += [None, "", "too short", "again and " * 60, " ".join(f"x{i}" for i in range(49)), " ".join(f"y{i}" for i in range(50))]
    out += [" ".join(f"long{i}" for i in range(30_000))] * 2
    return [(i, t, "en", rng.choice(("a", "b", "c", None)), 1, "clash", "clash", "clash") for i, t in enumerate(out)]


def good(text):
    words = WORD.findall(text or "")
    windows = list(zip(words, words[1:], words[2:], strict=False))
    count = Counter(windows)
    covered = {i + k for i, w in enumerate(windows) if count[w] > 1 for k in range(3)}
    return len(words) >= 50 and 100 * len(covered) <= 50 * len(words)


def brute_exact(docs):
    best = {}
    for r in docs:
        body = (r[1] or "").translate(UPPER)
        if body not in best or r[0] > best[body][0]:
            best[body] = r
    return list(best.values())


def brute_near(docs):
    sets = []
    for r in docs:
        w = WORD.findall((r[1] or "").translate(UPPER))
        sets.append({tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set())
    near = [[j for j, b in enumerate(sets) if a and 100 * len(a & b) >= 80 * len(a | b)] for a in sets]
    kept = []
    for i, r in enumerate(docs):
        seen, todo = {i}, [i]
        while todo:
            for j in near[todo.pop()]:
                if j not in seen:
                    seen.add(j)
                    todo.append(j)
        if r[0] == min(docs[j][0] for j in seen):
            kept.append(r)
    return kept


def test_stages_equal_brute_force(spark):
    functions = dict(corpus_pipeline.STAGES)
    assert list(functions) == ["quality_rules", "exact_dedup", "near_dedup", "mix", "encode"]
    given = rows()
    docs = spark.createDataFrame(given, SCHEMA)
    want = [r for r in given if good(r[1])]
    for name, reduce in (("quality_rules", lambda d: d), ("exact_dedup", brute_exact), ("near_dedup", brute_near)):
        want = reduce(want)
        docs = functions[name](spark, docs, "")
        assert docs.columns == SCHEMA.replace(" long", "").replace(" string", "").split(", ")
        assert sorted(tuple(r) for r in docs.collect()) == sorted(want), name
        docs = spark.createDataFrame(want, SCHEMA)
    want = [r for r in want if len(r[1]) < 10_000]  # no part of a text is taken, so a giant one could miss its source's target
    docs = spark.createDataFrame(want, SCHEMA)
    mixed = functions["mix"](spark, docs, "")
    copies = Counter(tuple(r) for r in mixed.collect())
    assert mixed.columns == docs.columns and set(copies) <= set(want) and max(copies.values()) <= 2
    words = sum(len(WORD.findall(r[1])) * n for r, n in copies.items())
    assert words == pytest.approx(1.5 * sum(len(WORD.findall(r[1])) for r in want), rel=0.01)
    library = Tokenizer.from_file(public_tokenizers.path(bpe.WORD_BPE))
    made = functions["encode"](spark, mixed, "").collect()
    assert Counter(r.doc_id for r in made) == Counter({r[0]: n for r, n in copies.items()})
    texts = {r[0]: r[1] for r in want}
    assert all(r.ids == library.encode(texts[r.doc_id], add_special_tokens=False).ids and r.n_tokens == len(r.ids) for r in made)


def test_stages_take_an_empty_table(spark):
    docs = spark.createDataFrame([], SCHEMA)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, "").collect() == []


def test_workers_get_texts_in_small_batches(spark):
    def sizes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_pydict({"rows": [batch.num_rows], "bytes": [batch.nbytes]})

    def seen(docs):
        return docs.select(F.struct("doc_id", "text").alias("row")).mapInArrow(sizes, "rows long, bytes long").collect()

    texts = F.concat(F.col("id").cast("string"), F.repeat(F.lit(" words of a text"), 500)).alias("text")
    docs = spark.range(4_000, numPartitions=1).select(F.col("id").alias("doc_id"), texts, F.lit("a").alias("source"))
    for name, stage in corpus_pipeline.STAGES:
        spark.conf.unset(corpus_pipeline.BATCH)
        stage(spark, docs.limit(0), "")
        found = seen(docs)
        assert sum(r.rows for r in found) == 4_000 and max(r.bytes for r in found) < 1.1 * corpus_pipeline.BATCH_BYTES, name
    spark.conf.set(corpus_pipeline.BATCH, "1m")
    corpus_pipeline.quality_rules(spark, docs.limit(0), "")
    assert spark.conf.get(corpus_pipeline.BATCH) == "1m"  # a session's own limit stays
    spark.conf.unset(corpus_pipeline.BATCH)


def test_run_applies_all_stages(spark, sf_dir):
    assert corpus_pipeline.run(spark, sf_dir).count() > 0
