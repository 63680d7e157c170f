"""Byte-level BPE against the tokenizers library, runs and divergences against plain Python."""

from __future__ import annotations

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tillstar.llm import byte_bpe, periodic_runs, queries, source_divergence
from tokenizers import Tokenizer

BPE = public_tokenizers.path("byte_bpe_50k.json")
WORD = re.compile(r"[^\x20\x09-\x0D]+")
TEXTS = [
    None,
    "",
    " ",
    "  \n\n  two\r\n\tspaces  ",
    "it's they'll I'D we've 'sx don't",
    "a1b22 3.14 x²½Ⅷ ٣ ",
    "日本語 \U0001f600‍\U0001f469 é  　 x",
    "<|endoftext|> a <|endoftext|><|endoftext|>b <|endoftext",
    "\x00\x1c\x1d\x1e\x1f\x85  ﻿᠎",
    "aaaa" * 900,
    "ab" * 2500 + " " * 3000 + "x",
    "=-" * 1000,
    "the same words " * 800,
]
ODD = "doc_id long, text string, lang string, source string, ids string, _given string, runs int, term string, n long, shard int"


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(BPE)


@pytest.fixture(scope="module")
def own():
    return byte_bpe.ByteBpe(BPE)


@pytest.fixture
def odd(spark):
    """Nulls, repeated rows, and columns with names that operators use inside."""
    rows = [(i, t, None, None, "clash", "clash", 1, "clash", 1, 1) for i, t in enumerate(TEXTS)]
    return spark.createDataFrame([*rows, rows[4], (None, "one one one one one one", "en", "s", *rows[0][4:])], ODD)


def ids_of(packed: bytes) -> list[int]:
    return np.frombuffer(packed, "<u4").tolist()


def test_bpe_equals_the_library(library, own):
    for text in filter(None, TEXTS):
        ids = library.encode(text, add_special_tokens=False).ids
        packed = own.encode(text)
        assert ids_of(packed) == ids
        assert own.decode(packed) == library.decode(ids, skip_special_tokens=False) == text


def test_every_character_is_cut_as_by_the_library(library, own):
    """Each character between letters, digits, signs and blanks."""
    for a in range(0, 0x110000, 0x800):
        codes = [chr(c) for c in range(a, a + 0x800) if not 0xD800 <= c < 0xE000]
        text = "\n".join(f"a{c}1{c} {c}.{c}" for c in codes)
        if not codes:
            continue
        pieces = [text[x:y] for _, (x, y) in library.pre_tokenizer.pre_tokenize_str(text)]
        assert own.split(text) == pieces


@settings(max_examples=150, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(text=st.text(st.sampled_from("aabbe thin<|>\n'sd é中1")))
def test_bpe_of_random_texts(library, own, text):
    assert ids_of(own.encode(text)) == library.encode(text, add_special_tokens=False).ids


def test_bpe_in_chunks_and_with_a_full_table(library, monkeypatch):
    monkeypatch.setattr(byte_bpe, "CHUNK", 7)
    monkeypatch.setattr(byte_bpe, "KEPT_BYTES", 1000)
    monkeypatch.setattr(byte_bpe, "SHORT", 5)
    own = byte_bpe.ByteBpe(BPE)
    for text in filter(None, TEXTS):
        packed = own.encode(text)
        assert ids_of(packed) == library.encode(text, add_special_tokens=False).ids
        assert own.decode(packed) == text


def test_decoding_of_broken_ids(library, own):
    rng = random.Random(3)
    for _ in range(300):
        ids = [rng.choice([rng.randrange(50257), rng.randrange(256), 60000]) for _ in range(rng.randrange(9))]
        packed = np.array(ids, "<u4").tobytes()
        assert own.decode(packed) == library.decode(ids, skip_special_tokens=False)


def test_long_pieces_take_no_square_time(own):
    import time

    start = time.perf_counter()
    own.merge([own.byte_ids[97 + (i * i) % 3] for i in range(100_000)])
    assert time.perf_counter() - start < 10


def test_bpe_query(spark, odd, library, tmp_path):
    odd.write.parquet(f"{tmp_path}/documents.parquet")
    expected = []
    for row in odd.collect():
        ids = library.encode(row.text or "", add_special_tokens=False).ids
        text = library.decode(ids, skip_special_tokens=False)
        digests = hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(text.encode()).hexdigest()
        expected.append((row.doc_id, len(ids), *digests))
    found = queries.op11_byte_bpe(spark, str(tmp_path))
    assert found.dtypes == [("doc_id", "bigint"), ("n_tokens", "bigint"), ("ids_sha256", "string"), ("decoded_sha256", "string")]
    assert sorted(map(str, map(tuple, found.collect()))) == sorted(map(str, expected))


def test_bpe_rejects_other_tokenizers():
    with pytest.raises(ValueError, match="byte-level"):
        byte_bpe.ByteBpe(public_tokenizers.path("word_bpe_49k.json"))


def plain_runs(words: list, min_length: int, min_exponent: float) -> list[tuple[int, int, int]]:
    """Stretches with equal words q apart, for every q; a stretch belongs to its smallest q."""
    found = {}
    for q in range(1, len(words) // 2 + 1):
        start = 0
        for i in range(len(words) - q + 1):
            if i == len(words) - q or words[i] != words[i + q]:
                if i > start:
                    stretch = (start, i + q)
                    if stretch[1] - stretch[0] >= max(min_length, min_exponent * q):
                        found.setdefault(stretch, q)
                start = i + 1
    return sorted((a, b - a, q) for (a, b), q in found.items())


def plain_collapse(words: list[str], runs: list[tuple[int, int, int]]) -> str:
    gone = {i for start, length, q in runs for i in range(start + q, start + length)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


def random_words(rng: random.Random) -> list[str]:
    words: list[str] = []
    for _ in range(rng.randrange(6)):
        root = [rng.choice("abcdé") for _ in range(rng.randrange(1, 7))]
        words += root * rng.randrange(1, 9) + root[: rng.randrange(len(root))]
        words += [rng.choice(["a", "b", "xy", "z"]) for _ in range(rng.randrange(5))]
    return words


@pytest.mark.parametrize(("min_length", "min_exponent"), [(6, 4), (2, 2), (5, 3), (6, 2.5)])
def test_runs_equal_brute_force(min_length, min_exponent):
    rng = random.Random(min_length)
    texts = [rng.choice([" ", "\n", "  "]).join(random_words(rng)) for _ in range(400)] + [None, "", "a", "a a"]
    counts, runs, collapsed = periodic_runs.find_runs(pa.array(texts, pa.string()), min_length, min_exponent)
    for text, n, found, short in zip(texts, counts.to_pylist(), runs.to_pylist(), collapsed.to_pylist(), strict=True):
        words = WORD.findall(text or "")
        expected = plain_runs(words, min_length, min_exponent)
        assert n == len(words)
        assert [(r["start"], r["length"], r["period"]) for r in found] == expected
        assert short == plain_collapse(words, expected)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text("ab", min_size=0, max_size=60), max_size=4))
def test_runs_of_two_letters(texts):
    texts = [" ".join(t) for t in texts]
    _, runs, _ = periodic_runs.find_runs(pa.array(texts, pa.string()), 2, 2)
    assert [[(r["start"], r["length"], r["period"]) for r in found] for found in runs.to_pylist()] == [plain_runs(t.split(), 2, 2) for t in texts]


def test_runs_in_small_parts(monkeypatch):
    rng = random.Random(8)
    texts = pa.array([" ".join(random_words(rng)) for _ in range(50)])
    whole = periodic_runs.find_runs(texts)
    monkeypatch.setattr(periodic_runs, "TESTS", 3)
    assert [x.to_pylist() for x in periodic_runs.find_runs(texts)] == [x.to_pylist() for x in whole]


def test_words_of_equal_hash_stay_different():
    """Thue-Morse words and their complements, which polynomial hashes to a power of two confuse."""
    one = "".join("ab"[bin(i).count("1") % 2] for i in range(4096))
    two = one.translate(str.maketrans("ab", "ba"))
    _, runs, _ = periodic_runs.find_runs(pa.array([f"{one} {two} " * 8]))
    assert [tuple(r.values()) for r in runs.to_pylist()[0]] == [(0, 16, 2)]


def test_long_runs():
    counts, runs, collapsed = periodic_runs.find_runs(pa.array(["word " * 200_000, "a b c " * 100_000 + "d"]))
    assert [[tuple(r.values()) for r in found] for found in runs.to_pylist()] == [[(0, 200_000, 1)], [(0, 300_000, 3)]]
    assert collapsed.to_pylist() == ["word", "a b c d"]


def plant(doc_id, words):
    code = None if doc_id is None else zlib.crc32(str(doc_id).encode())
    if code is None or code % 10 or not words:
        return words
    g, n = code // 10, len(words)
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]


def test_runs_query(spark, odd, tmp_path):
    rng = random.Random(5)
    more = [(i, " \n".join(f"w{rng.randrange(40)}" for _ in range(rng.randrange(120))), *[None] * 8) for i in range(100, 400)]
    docs = odd.unionByName(spark.createDataFrame(more, ODD))
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    expected = []
    for row in docs.collect():
        words = plant(row.doc_id, WORD.findall(row.text or ""))
        runs = plain_runs(words, 6, 4) if len(words) < 3000 else [(0, len(words), 3)]
        best = max(runs, key=lambda r: (r[1], -r[0], -r[2]), default=(None, None, None))
        milli = None if not runs else 1000 * best[1] // best[2]
        lines = "".join(f"{a},{b},{c}\n" for a, b, c in runs)
        digests = [hashlib.sha256(x.encode()).hexdigest() for x in (lines, plain_collapse(words, runs))]
        expected.append((row.doc_id, len(runs), *best, milli, *digests))
    found = queries.op12_periodic_runs(spark, str(tmp_path))
    names = ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    assert found.dtypes == [(n, "string" if "sha" in n else "bigint") for n in names]
    assert sorted(map(str, map(tuple, found.collect()))) == sorted(map(str, expected))
    assert sum(r[1] > 0 for r in expected) > 15


def plain_divergence(rows, min_docs, top):
    """The contract word by word, with Python's integers."""
    docs, counts, groups = defaultdict(Counter), defaultdict(Counter), set()
    for text, lang, source in rows:
        lang, source = lang or "", source or ""
        terms = [re.sub("[A-Z]", lambda m: m[0].lower(), t) for t in re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", text or "")]
        groups.add((lang, source))
        docs[lang].update(set(terms))
        counts[lang, source].update(terms)
        counts[lang, None].update(terms)
    out = []

    def share(lang, source, term):
        kept = [t for t, n in docs[lang].items() if n >= min_docs]
        held = counts[lang, source]
        return 1 + (10**9 * (held[term] + 2)) // (sum(held[t] for t in kept) + 2 * len(kept))

    def apart(p, q):
        return (p - q) ** 2 // (p + q)

    for lang, source in groups:
        kept = [t for t, n in docs[lang].items() if n >= min_docs]
        own = {t: share(lang, source, t) for t in kept}
        pairs = [(o, sum(apart(own[t], share(lang, o, t)) for t in kept)) for x, o in groups if x == lang and o != source]
        every = {t: share(lang, None, t) for t in kept}
        terms = [(t, apart(own[t], every[t])) for t in kept if counts[lang, source][t] and own[t] > every[t]]
        for part, items, most in (("pair", pairs, None), ("term", terms, top)):
            ranked = sorted(items, key=lambda x: (-x[1], x[0].encode()))[:most]
            out += [(lang, source, part, item, value, i + 1) for i, (item, value) in enumerate(ranked)]
    return out


@pytest.mark.parametrize("cells", [None, 40])
def test_divergence_equals_brute_force(spark, monkeypatch, cells):
    if cells:
        monkeypatch.setattr(source_divergence, "SHARD_CELLS", cells)
        monkeypatch.setattr(source_divergence, "PART_BYTES", 300)
        monkeypatch.setattr(source_divergence, "BLOCK_CELLS", 16)
    rng = random.Random(2)
    vocabulary = [w + x for w in ("Alpha", "BETA", "émile", "Über", "日本", "ÀB", "z", "\U0001f600") for x in ("", "a", "é", "Z", "q")]
    rows = []
    for _ in range(260):
        lang, source = rng.choice(["en", "en", "de", None, ""]), rng.choice(["s1", "s1", "s1", "S2", "é", "", None])
        words = rng.choices(vocabulary, weights=range(1, len(vocabulary) + 1), k=rng.randrange(20))
        rows.append((rng.choice([" ", "-", "\x00", "1"]).join(words), lang, source))
    rows += [(None, "xx", "a"), ("", "xx", "b"), ("lone term", "xx", "c"), rows[0], rows[0]]
    docs = spark.createDataFrame([(*r, "x", 1, 1) for r in rows], "text string, lang string, source string, term string, n int, shard int")
    found = source_divergence.source_divergence(docs, min_docs=10, top=10)
    assert found.dtypes == [("lang", "string"), ("source", "string"), ("part", "string"), ("item", "string"), ("value", "bigint"), ("rank", "int")]
    assert sorted(map(tuple, found.collect())) == sorted(plain_divergence(rows, 10, 10))


def test_divergence_of_nothing(spark):
    none = spark.createDataFrame([], "text string, lang string, source string")
    assert source_divergence.source_divergence(none).collect() == []
    one = spark.createDataFrame([(None, None, None)], none.schema)
    assert source_divergence.source_divergence(one).collect() == []


def test_shares_are_exact_for_large_counts():
    rng = random.Random(4)
    for _ in range(200):
        total, kept = rng.randrange(10**15), rng.randrange(1, 10**6)
        n = rng.randrange(total + 1)
        assert source_divergence.shares(np.array([n]), total, kept)[0] == 1 + (10**9 * (n + 2)) // (total + 2 * kept)


def test_runs_and_codes_keep_every_row(spark, odd):
    assert periodic_runs.periodic_runs(odd).count() == len(TEXTS) + 2
    coded = byte_bpe.encode(odd, BPE, carry=("doc_id", "lang"))
    assert coded.columns == ["doc_id", "lang", "ids"]
    empty = odd.limit(0)
    assert periodic_runs.periodic_runs(empty).count() == byte_bpe.decode(byte_bpe.encode(empty, BPE), BPE).count() == 0
    assert math.isclose(byte_bpe.encode(odd, BPE).select(F.sum(F.octet_length("ids"))).first()[0] % 4, 0)
