"""Joins, repeats, mixing, rules, filters and classifiers against brute force on small corpora."""

from __future__ import annotations

import hashlib
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F
from tillstar.llm import decontamination, fm_index, mixing, ngram_join, quality_classifier, quality_rules, substring_dedup, url_rules
from tillstar.llm.components import component_labels

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SHAPE = "doc_id long, text string, lang string, source string, n_chars long, id string, row string, key string"


def prose(rng, n, vocabulary=400):
    return [f"w{rng.randrange(vocabulary)}" for _ in range(n)]


def corpus(seed=1):
    """Originals, exact and near copies, chains of edits, a shared passage, short and empty texts."""
    rng = random.Random(seed)
    texts = []
    for _ in range(40):
        words = prose(rng, rng.randrange(1, 160))
        texts.append(words)
        for _ in range(rng.choice((0, 0, 1, 4))):
            words = list(words)
            for _ in range(rng.choice((0, 1, 3))):
                words[rng.randrange(len(words))] = f"e{rng.randrange(99)}"
            texts.append(words)
    passage = prose(rng, 70)
    texts += [prose(rng, 18) + passage + prose(rng, rng.randrange(4)) for _ in range(25)]
    texts += [["a"], ["A"], ["a", "b", "c", "d", "e"], ["a", "b", "c", "d", "e"], ["x"] * 500, ["x"] * 600]
    joined = [" ".join(t) for t in texts] + [None, "", " \n ", "A  b\tc D e"]
    order = list(range(len(joined)))
    rng.shuffle(order)
    return [(i, joined[j], "en", f"s{j % 3}", 0) for i, j in enumerate(order)]


@pytest.fixture(scope="module")
def rows():
    return corpus()


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame([(*r, "c", "c", "c") for r in rows], SHAPE).repartition(5).cache()


def components(rows):
    sets = {}
    for i, text, *_ in rows:
        words = [w.lower() for w in WORD.findall(text or "")]
        sets[i] = frozenset(zip(*(words[j:] for j in range(5)), strict=False)) if len(words) >= 5 else frozenset([tuple(words)] if words else [])
    parent = {i: i for i in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(sets)
    for p, a in enumerate(ids):
        for b in ids[p + 1 :]:
            if sets[a] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b]):
                x, y = root(a), root(b)
                parent[max(x, y)] = min(x, y)
    return {i: (len(sets[i]), root(i)) for i in ids}


@pytest.mark.parametrize(("frequent", "pivots", "sketch"), [(64, 8, 4), (2, 8, 4), (2, 2, 0)])
def test_near_copies(docs, rows, monkeypatch, frequent, pivots, sketch):
    monkeypatch.setattr(ngram_join, "FREQUENT", frequent)
    monkeypatch.setattr(ngram_join, "PIVOTS", pivots)
    monkeypatch.setattr(ngram_join, "SKETCH", sketch)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in ngram_join.similar_documents(docs).collect()}
    assert got == components(rows)


def test_near_copies_of_odd_rows(spark, docs):
    assert ngram_join.similar_documents(docs.limit(0)).count() == 0
    odd = spark.createDataFrame([(None, "a b"), (3, "a b"), (3, "a b"), (2, None)], "doc_id long, text string")
    got = sorted(map(str, (tuple(r) for r in ngram_join.similar_documents(odd).collect())))
    assert got == sorted(map(str, [(None, 1, None), (3, 1, 3), (3, 1, 3), (2, 0, 2)]))


def test_keys_close_when_all_their_classes_were_pivots(spark):
    members = [(1, i, i) for i in range(3)] + [(2, i, i) for i in range(9)] + [(3, i, 7) for i in range(9)]
    members = spark.createDataFrame(members, "key long, rep long, label long")
    found = [{(r.key, r.m) for r in ngram_join._open_keys(members, turn).collect()} for turn in (1, 2, 3)]
    assert found == [{(1, 3), (2, 9)}, {(2, 9)}, set()]


def test_sets_without_possible_partners_leave(spark):
    common = [(1, 4, [(1, 2), (2, 2), (3, 2)]), (2, 4, [(1, 2), (2, 2)]), (3, 5, [(1, 2), (2, 2), (3, 2)])]
    common = spark.createDataFrame(common, "rep long, n long, common array<struct<shingle long, df long>>")
    assert [r.rep for r in ngram_join._linkable(common, 75, 100).collect()] == [1]


def test_components_of_a_long_chain(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(100, 160)] + [(5, 7), (7, 5), (9, 9)], "a long, b long")
    got = {r.node: r.component for r in component_labels(links, "a", "b").collect()}
    assert got == {**{i: 100 for i in range(100, 161)}, 5: 5, 7: 5}


def test_index_keys_of_linked_sets_meet():
    rng = np.random.default_rng(5)
    for _ in range(200):
        n = int(rng.integers(3, 120))
        universe = np.arange(1, 400, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        frequency = dict(zip(universe.tolist(), rng.integers(2, 120, len(universe)).tolist(), strict=True))
        x = rng.choice(universe, n, replace=False)
        y = np.concatenate([x[int(rng.integers(0, n // 8 + 1)) :], rng.choice(universe, int(rng.integers(0, 3)))])
        y = np.unique(y)
        common = len(np.intersect1d(x, y))
        if 100 * common < 75 * (len(x) + len(y) - common) or len(x) == len(y) == common:
            continue
        met = []
        for s in (x, y):
            f = np.array([frequency[v] for v in s.tolist()])
            order = np.lexsort((s, f))
            met.append(set(ngram_join.index_keys(len(s), f[order], s[order], 75, 100)[0].tolist()))
        assert met[0] & met[1]


def cut(rows, length=50):
    words = {i: WORD.findall(t or "") for i, t, *_ in rows}
    first = {}
    for i in sorted(words):
        for j in range(len(words[i]) - length + 1):
            first.setdefault(tuple(words[i][j : j + length]), i)
    out = {}
    for i, own in words.items():
        gone = set()
        for j in range(len(own) - length + 1):
            if first[tuple(own[j : j + length])] < i:
                gone.update(range(j, j + length))
        kept = [w for j, w in enumerate(own) if j not in gone]
        out[i] = (len(own), len(gone), hashlib.sha256(" ".join(kept).encode()).hexdigest())
    return out


@pytest.mark.parametrize("shard_words", [300_000, 500])
def test_repeated_passages(docs, rows, monkeypatch, shard_words):
    monkeypatch.setattr(substring_dedup, "SHARD_WORDS", shard_words)
    got = {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in substring_dedup.removed_words(docs).collect()}
    assert got == cut(rows)
    assert sum(r[1] for r in got.values()) > 1000


def test_repeated_passages_of_odd_rows(spark, docs):
    assert substring_dedup.removed_words(docs.limit(0)).count() == 0
    long = " ".join(f"v{i}" for i in range(60))
    odd = spark.createDataFrame([(None, long), (4, long), (4, long), (9, "q " + long), (2, None)], "doc_id long, text string")
    got = sorted((str(r.doc_id), r.n_words, r.n_removed) for r in substring_dedup.removed_words(odd).collect())
    assert got == [("2", 0, 0), ("4", 60, 0), ("4", 60, 0), ("9", 61, 60), ("None", 60, 0)]


def test_wavelet_matrix_ranks():
    rng = np.random.default_rng(2)
    symbols = rng.integers(0, 37, 500)
    matrix = fm_index.WaveletMatrix(symbols, 37)
    for s, i in rng.integers(0, [37, 501], (200, 2)):
        assert matrix.rank(np.array([s]), np.array([i]))[0] == (symbols[:i] == s).sum()


def test_sliding_minimum():
    values = np.random.default_rng(4).integers(0, 99, 60)
    for width in (1, 2, 3, 7, 46, 60, 61):
        assert substring_dedup.sliding_minimum(values, width).tolist() == [values[i : i + width].min() for i in range(60 - width + 1)]


def test_benchmark_items(spark, docs):
    rng = random.Random(8)
    item = "A train leaves Boston at 40 km per hour and meets Anna after 3 hours on the long way to the coast."
    other = item.replace("Boston", "Lisbon").replace("40", "55").replace("Anna", "Tom").replace("3", "7")
    mixed_up = "A train leaves Boston at 40 km per hour and meets Anna after 3 hours"
    wrap = lambda t: " ".join(prose(rng, 60)) + ". " + t + " " + " ".join(prose(rng, 60))
    texts = [wrap(item), wrap(other), wrap("plain words"), wrap("A train leaves Boston at night."), None, "", wrap(item.lower()), wrap(mixed_up)]
    frame = spark.createDataFrame([(i, t, "clash") for i, t in enumerate(texts)] + [(0, texts[0], "x")], "doc_id long, text string, item_id string")
    bench = spark.createDataFrame([(1, item), (2, None), (3, ""), (4, "tiny one")], "item_id long, text string")
    got = decontamination.judge_contamination(frame, bench).collect()
    assert len(got) == len(texts) + 1
    assert {r.doc_id for r in got if r.contaminated} == {0, 1, 7}
    assert {r.item_id for r in got if r.contaminated} == {1}
    assert decontamination.without_items(frame, bench).count() == len(texts) - 3
    assert not decontamination.judge_contamination(frame, bench.limit(0)).where("contaminated").count()
    assert decontamination.judge_contamination(frame.limit(0), bench).count() == 0


def test_items_beside_other_fillings_of_their_template(spark):
    item = "A train leaves Boston at 40 km per hour and meets Anna after 3 hours on the long way to the coast."
    other = item.replace("Boston", "Lisbon").replace("40", "55").replace("Anna", "Tom").replace("3", "7")
    third = item.replace("Boston", "Quito").replace("40", "66").replace("Anna", "Ida").replace("3", "9")
    halves = item.split(" and meets ")
    texts = [f"{item} {other}", " ".join(["Questions.", third, other, item]), f"{halves[0]} and meets {' '.join(prose(random.Random(1), 40))}. and meets {halves[1]}", "no such words here at all in this text"]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    bench = spark.createDataFrame([(1, item), (2, other)], "item_id long, text string")
    got = {r.doc_id: r for r in decontamination.judge_contamination(frame, bench).collect()}
    assert [got[i].contaminated for i in range(4)] == [True, True, True, False]
    assert got[0].n_items == got[1].n_items == 2 and got[0].coverage == 1.0


def test_lists_of_numbers_and_names(spark):
    """A window of slots alone has the template of any other, so only its values count."""
    numbers = lambda a: " ".join(str(a + 7 * i) for i in range(16))
    item = numbers(100)
    rows = [(1, f"Table {numbers(5000)}"), (2, f"Table {item} end"), (3, " ".join(str(i) for i in range(30_000, 90_000))), (4, " ".join(f"Ab{i}" for i in range(20_000)))]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    bench = spark.createDataFrame([(1, item)], "item_id long, text string")
    got = {r.doc_id: r.contaminated for r in decontamination.judge_contamination(frame, bench).collect()}
    assert got == {1: False, 2: True, 3: False, 4: False}


def test_occurrences():
    steps = [(0, 0), (1, 1), (4, 2), (5, 3), (30, 0), (31, 1), (40, 3), (41, 2)]
    assert decontamination.occurrences(steps) == [steps[:4], [(30, 0), (31, 1), (40, 3)], [(41, 2)]]


def test_short_items_and_passages_of_long_ones(spark):
    rng = random.Random(9)
    long = prose(rng, 200, 5000)
    wrap = lambda t: " ".join(prose(rng, 20, 5000)) + ". " + t + " " + " ".join(prose(rng, 20, 5000))
    texts = [wrap("What is 7 plus 5?"), wrap("What is 7 minus 5?"), wrap(" ".join(long[80:120])), wrap(" ".join(long[80:92])), "What is 8 plus 2?", wrap("It has 12 rooms"), wrap("It has 42 rooms")]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    bench = spark.createDataFrame([(1, "What is 7 plus 5?"), (2, " ".join(long)), (3, "42")], "item_id long, text string")
    got = {r.doc_id: r.item_id for r in decontamination.judge_contamination(frame, bench).where("contaminated").collect()}
    assert got == {0: 1, 2: 2, 4: 1, 6: 3}


def test_benchmark_join_beyond_the_lookup(spark, monkeypatch):
    words = " ".join(f"k{i}" for i in range(30))
    frame = spark.createDataFrame([(1, f"x y {words} z"), (2, "k1 k2 k3")], "doc_id long, text string")
    bench = spark.createDataFrame([(1, words)], "item_id long, text string")
    few = decontamination.judge_contamination(frame, bench).collect()
    monkeypatch.setattr(decontamination, "LOOKUP_WINDOWS", 0)
    assert sorted(decontamination.judge_contamination(frame, bench).collect()) == sorted(few)
    assert [r.contaminated for r in sorted(few)] == [True, False]


def test_mix_meets_its_targets(docs, rows):
    got = mixing.mix_sources(docs).collect()
    assert len(got) == len(rows)
    total = sum(r.size for r in got)
    by_source = {}
    for r in got:
        by_source.setdefault(r.source, []).append(r)
        assert 0 <= r.taken <= 2 * r.size
    assert sum(v[0].target for v in by_source.values()) == pytest.approx(1.5 * total)
    for own in by_source.values():
        assert own[0].target <= 2 * own[0].source_size == 2 * sum(r.size for r in own)
        assert abs(sum(r.taken for r in own) - own[0].target) <= 0.5
    assert sorted(mixing.mix_sources(docs.repartition(3)).collect()) == sorted(got)


@pytest.mark.parametrize("slice_rows", [50_000, 3])
def test_mix_order_does_not_depend_on_slices(docs, monkeypatch, slice_rows):
    plain = sorted(mixing.mix_sources(docs).collect())
    monkeypatch.setattr(mixing, "SLICE_ROWS", slice_rows)
    assert sorted(mixing.mix_sources(docs).collect()) == plain


def test_mix_of_odd_rows(spark, docs):
    assert mixing.mix_sources(docs.limit(0)).count() == 0
    odd = spark.createDataFrame([(1, None, None), (2, "a b", None), (None, "c", "z"), (2, "a b", None), (5, "", "only empty")], "doc_id long, text string, source string")
    got = mixing.mix_sources(odd).collect()
    assert len(got) == 5 and sum(r.taken for r in got) == pytest.approx(7.5, abs=1)
    assert [r.target for r in got if r.source == "only empty"] == [0.0]


def test_documents_of_the_mix(spark):
    frame = spark.createDataFrame([(i, "w " * 10, f"s{i % 2}", i) for i in range(40)], "doc_id long, text string, source string, size long")
    out = mixing.mixed_documents(frame)
    assert out.columns == frame.columns and out.count() == 60


def test_mix_of_documents_without_or_with_repeated_ids(spark):
    rows = [(None, f"n{i} x y z", "s", None) for i in range(6)] + [(7, "a b c d", "s", i) for i in range(3)] + [(7, "other text is here", "s", 9)] + [(20 + i, "e f g h", "t", None) for i in range(10)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, source string, size long")
    out = mixing.mixed_documents(frame, share=2.0)
    assert out.columns == frame.columns
    assert sorted(map(str, map(tuple, out.collect()))) == sorted(map(str, rows * 2))


def counts(text):
    words = WORD.findall(text or "")
    triples = list(zip(words, words[1:], words[2:], strict=False))
    covered = {j for i, t in enumerate(triples) if triples.count(t) > 1 for j in (i, i + 1, i + 2)}
    lines = [line for line in (text or "").split("\n") if WORD.search(line)]
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(covered)


def test_quality_counts(spark):
    texts = [None, "", " \n", "a", "a b c a b c", "a b a b a b a", "x # y\nx # y\n\n é||\n", "one two three\v four\f five", "r " * 400, "a\u00a0b c"]
    frame = spark.createDataFrame([(i, t, 1) for i, t in enumerate(texts)], "doc_id long, text string, n_words int")
    got = {r.doc_id: r for r in quality_rules.judge_quality(frame).collect()}
    for i, text in enumerate(texts):
        r = got[i]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == counts(text)
        assert r.base_failed == (r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words)
        assert not (r.base_failed and r.kept)
    assert quality_rules.judge_quality(frame.limit(0)).count() == 0


def test_windows_of_a_very_long_text(spark):
    words = [f"w{i}" for i in range(600_000)]
    words[-3:] = words[:3]
    text = spark.createDataFrame([(1, " ".join(words))], "doc_id long, text string")
    assert quality_rules.features(text).first().n_repeat_words == 6


def test_quality_verdicts(spark):
    rng = random.Random(3)
    clean = [". ".join(" ".join(prose(rng, 9, 5000)).capitalize() for _ in range(12)) + "." for _ in range(90)]
    junk = [" ".join(w + "###" for w in prose(rng, 100, 5000)) for _ in range(6)] + [" ".join(w.upper() + "!!" for w in ("abc" + x for x in prose(rng, 100, 5000))) for _ in range(4)]
    frame = spark.createDataFrame(list(enumerate(clean + junk)), "doc_id long, text string")
    kept = {r.doc_id for r in quality_rules.judge_quality(frame).where("kept").collect()}
    assert kept == set(range(90))


URLS = [
    ("http://a.net/x", "net/", "block"), ("http://a.net", None, "allow"), ("http://www.EXAMPLE.net/en/1", "example.net/en/", "allow"),
    ("https://example.net/de/1", "net/", "block"), ("http://x.example.com/de/?q#f", "example.com/de/", "block"), ("http://myexample.com/de/", None, "allow"),
    ("http://b.org/fr/9.html", "org/fr/", "allow"), ("http://b.org/fr", None, "allow"), ("nothing", None, "allow"), (None, None, "allow"), ("", None, "allow"),
    ("http://u?x://y.net/", None, "allow"), ("s://h#f/fr/", None, "allow"),
]


def test_given_url_rules(spark):
    pages = spark.createDataFrame([(i, u, "clash") for i, (u, _, _) in enumerate(URLS)] + [(0, URLS[0][0], "twice")], "page_id long, url string, host string")
    none = spark.createDataFrame([], "antecedent array<string>, confidence double, support double")
    got = url_rules.judge_urls(pages, none).collect()
    assert len(got) == len(URLS) + 1
    for r in got:
        assert (r.rule, r.verdict) == URLS[r.page_id][1:], URLS[r.page_id]
    found = {r.page_id: (r.host, r.path) for r in got}
    assert [found[i] for i in (2, 4, 8, 9, 11, 12)] == [("www.example.net", "/en/1"), ("x.example.com", "/de/"), ("", ""), ("", ""), ("u", ""), ("h", "")]


def test_mined_url_rules(spark):
    bad = [(f"http://pills.example.io/buy/{i}?utm=x", True) for i in range(20)]
    good = [(f"http://news{i % 7}.example.io/read/{i}?utm=x", False) for i in range(80)]
    labelled = spark.createDataFrame([*bad, *good, (None, True)], "url string, bad boolean")
    rules = url_rules.mine_rules(labelled)
    assert {tuple(r.antecedent) for r in rules.collect()} == {("h:pills",), ("p:buy",)}
    pages = spark.createDataFrame([(1, "http://pills.example.io/q"), (2, "http://news1.example.io/read/1"), (3, "http://x.io/buy/2"), (4, "http://pills.net/a")], "page_id long, url string")
    got = {r.page_id: (r.mined, r.verdict) for r in url_rules.judge_urls(pages, rules).collect()}
    assert got == {1: ("h:pills", "block"), 2: (None, "allow"), 3: ("p:buy", "block"), 4: ("h:pills", "block")}
    assert url_rules.mine_rules(labelled.limit(0)).count() == 0


def test_classifier_on_held_out_labels(spark):
    rng = random.Random(6)
    good = [". ".join(" ".join(prose(rng, 8, 3000)).capitalize() for _ in range(10)) + "." for _ in range(160)]
    junk = [" ".join(w.upper() + "!!" for w in ("q" + x for x in prose(rng, 80, 3000))) for _ in range(40)]
    texts = good + junk
    frame = spark.createDataFrame([(i, t, "en", None, len(t), 0.5) for i, t in enumerate(texts)] + [(None, None, None, None, None, None)], "doc_id long, text string, lang string, source string, n_chars long, p_good double")
    labels = spark.createDataFrame([(i, int(i < 160), 0) for i in range(0, 200, 2)], "doc_id long, quality int, toxic int")
    got = quality_classifier.score(frame, labels, ("doc_id",)).collect()
    assert len(got) == 201
    held_out = [r for r in got if r.doc_id is not None and r.doc_id % 2]
    assert all(r.kept == (r.doc_id < 160) for r in held_out)
    unlearned = quality_classifier.score(frame, labels.where("quality = 1"), ("doc_id",))
    assert unlearned.where(F.col("kept") & F.col("p_good").isNull()).count() == 201
    assert quality_classifier.score(frame.limit(0), labels, ("doc_id",)).count() == 0
