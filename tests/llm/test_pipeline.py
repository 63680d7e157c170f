"""The pipeline over a small corpus: every stage's decision against plain rules."""

from __future__ import annotations

import random

import corpus_pipeline
import pytest


def prose(rng, n):
    words = [f"w{rng.randrange(4000)}" for _ in range(n)]
    return ". ".join(" ".join(words[i : i + 9]).capitalize() for i in range(0, n, 9)) + "."


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    rng = random.Random(11)
    item = prose(rng, 40)
    good = [prose(rng, 90) for _ in range(100)]
    junk = [" ".join(f"Q{rng.randrange(999)}!!" for _ in range(90)) for _ in range(30)]
    leaks = [prose(rng, 60) + " " + item + " " + prose(rng, 60) for _ in range(5)]
    texts = good + junk + leaks + good[:6] + [good[7] + " and more"]
    rows = [(i, t, "en", f"s{i % 4}", len(t)) for i, t in enumerate(texts)]
    path = str(tmp_path_factory.mktemp("tables"))
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame([(i, int(i < 100), 0) for i in range(0, 130, 2)], "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    return path


def test_stages(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    seen = []
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, folder).cache()
        assert tuple(docs.columns) == corpus_pipeline.COLUMNS, name
        seen.append({r.doc_id for r in docs.select("doc_id").collect()})
    clean = set(range(100))
    assert seen[0] == clean | set(range(130, 142))
    assert seen[1] == clean | set(range(130, 135))
    assert seen[2] == clean
    taken = corpus_pipeline.STAGES[-1][1](spark, docs, folder)
    assert taken.count() == docs.count()


def test_run(spark, folder):
    out = corpus_pipeline.run(spark, folder).collect()
    ends = sorted((r.start, r.start + r.n_tokens) for r in out)
    assert ends[0][0] == 0 and all(a[1] == b[0] for a, b in zip(ends, ends[1:], strict=False))
    assert {r.doc_id for r in out} <= set(range(100))


def test_null_and_repeated_ids(spark, folder):
    rng = random.Random(12)
    first, second, third = prose(rng, 90), prose(rng, 90), prose(rng, 90)
    rows = [(3, first), (3, second), (2, first + " and more"), (5, third), (5, third), (None, third), (None, third), (None, None), (8, None)]
    docs = spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    once = corpus_pipeline.one_of_each(spark, docs, folder)
    expected = [(3, second), rows[2], (5, third), (None, third), (None, None), (8, None)]
    assert sorted(map(str, ((r.doc_id, r.text) for r in once.collect()))) == sorted(map(str, expected))
    clean = corpus_pipeline.without_benchmark(spark, once, folder)
    assert clean.count() == len(expected)
    mixed = corpus_pipeline.mixed(spark, clean, folder)
    assert {(r.doc_id, r.text) for r in mixed.collect()} <= set(expected[:4])
