"""Word hashes, token counts, token files and HTML against plain Python."""

from __future__ import annotations

import random
import re
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tillstar.llm import html_extract, textops, token_counts, token_files

TEXTS = [
    None,
    "",
    " ",
    "one",
    "A b c D e f",
    "a B C d E f",
    "x\ty\n\nz  w\u00a0v \u3000 u",
    "日本語 \U0001f600!! it's 3,5",
    "<|endoftext|> x<|startoftext|>y",
    "the same " * 300,
    "w" * 5000,
]
WORD = re.compile(r"[^\x20\x09-\x0D]+")
ODD = "doc_id long, text string, lang string, id string, rep string"


@pytest.fixture
def odd(spark):
    """Nulls, repeated rows, and columns with names that operators use inside."""
    rows = [(i, t, None, "clash", "clash") for i, t in enumerate(TEXTS)]
    return spark.createDataFrame([*rows, rows[4], (None, "one", "en", None, None)], ODD)


def test_words_and_their_hashes():
    words = textops.words_of(pa.array(TEXTS, pa.string()), lower=True)
    raw = words.data.tobytes()
    found = [[raw[words.starts[i] : words.ends[i]].decode() for i in range(a, b)] for a, b in zip(words.first[:-1], words.first[1:], strict=True)]
    assert found == [WORD.findall(t or "") for t in TEXTS]
    flat = [re.sub("[A-Z]", lambda m: m[0].lower(), w) for t in found for w in t]
    by_hash = {}
    for word, value in zip(flat, words.hashes.tolist(), strict=True):
        assert by_hash.setdefault(word, value) == value
    assert len(set(by_hash.values())) == len(by_hash)


def test_ids_of_odd_texts():
    from tokenizers import Tokenizer

    path = public_tokenizers.path("word_bpe_49k.json")
    library, rng = Tokenizer.from_file(path), random.Random(1)
    signs = "aAbZz019.,-'<|>sé日½_$ \n\t "
    texts = ["".join(rng.choice(signs) for _ in range(rng.randrange(40))) for _ in range(3000)]
    texts += ["<|endoftext|>x1<|startoftext|>", "a<|endoftext|>1", "it's 'some I'LL 'RE9 O'1", "", "<|startoftext|", "|>"]
    ids, sizes, _ = token_files.token_ids(pa.array(texts), path, end_id=2)
    ends = np.cumsum(sizes)
    for text, n, end in zip(texts, sizes, ends, strict=True):
        assert ids[end - n : end - 1].tolist() == library.encode(text, add_special_tokens=False).ids, text
    assert token_files.encodes_by_pieces(path) and not token_files.encodes_by_pieces(public_tokenizers.path("byte_bpe_50k.json"))


def test_ids_of_latin_words():
    from tokenizers import Tokenizer

    path = public_tokenizers.path("word_bpe_49k.json")
    library, rng = Tokenizer.from_file(path), random.Random(2)
    signs = [*map(chr, range(0xC0, 0x100)), *"aZ1,!'| \n", "\u0301", "\u0178", "\u00b5"]
    texts = ["".join(rng.choice(signs) for _ in range(rng.randrange(20))) for _ in range(3000)]
    ids, sizes, _ = token_files.token_ids(pa.array(texts), path, end_id=2)
    for text, n, end in zip(texts, sizes, np.cumsum(sizes), strict=True):
        assert ids[end - n : end - 1].tolist() == library.encode(text, add_special_tokens=False).ids, text
    refine = token_files._encoder(path)[2]
    pieces = textops.spell(pa.array(["\u00c9t\u00e9, \u00e9t\u00e9!"]), refine=refine).distinct
    assert [p.decode() for p in pieces] == ["\u00e9t\u00e9", ",", "!"]


def thue_morse(n):
    """Two words that polynomial hashes modulo a power of two can't tell apart."""
    one = "".join("ab"[bin(i).count("1") % 2] for i in range(n))
    return one, one.translate(str.maketrans("ab", "ba"))


@pytest.mark.parametrize("n", [1024, 2048, 4096])
def test_long_words_are_told_apart(spark, n):
    from tokenizers import Tokenizer

    one, two = thue_morse(n)
    words = textops.words_of(pa.array([f"{one} {two}"]))
    assert len(set(words.hashes.tolist())) == len(set(words.codes.tolist())) == 2
    path = public_tokenizers.path("word_bpe_49k.json")
    ids, _, _ = token_files.token_ids(pa.array([f"{one} {two}"]), path, end_id=2)
    assert ids.tolist()[:-1] == Tokenizer.from_file(path).encode(f"{one} {two}", add_special_tokens=False).ids
    both = [textops.shingles_of(pa.array([f"a b {w} d e"])).hashes.tolist() for w in (one, two)]
    assert both[0] != both[1]
    rest = " ".join(f"w{i}" for i in range(60))
    docs = spark.createDataFrame([(1, f"{one} {rest}"), (2, f"{two} {rest}")], "doc_id long, text string")
    from tillstar.llm.substring_dedup import removed_words

    assert [r.n_removed for r in removed_words(docs).orderBy("doc_id").collect()] == [0, 60]


def test_shingles():
    sets = textops.shingles_of(pa.array(TEXTS, pa.string()))
    sizes = np.diff(sets.first).tolist()
    expected = []
    for text in TEXTS:
        words = [w.lower() for w in WORD.findall(text or "")]
        expected.append(len(set(zip(*(words[i:] for i in range(5)), strict=False))) if len(words) >= 5 else bool(words))
    assert sizes == expected
    assert (sets.hashes[sets.first[4] : sets.first[5]] == sets.hashes[sets.first[5] : sets.first[6]]).all()


def test_word_table_restarts_when_full():
    table = textops.WordTable(lambda words: [[len(w), 7] for w in words], most=3)
    for text in ("a bb ccc", "a dddd", "a a bb"):
        words = textops.words_of(pa.array([text]))
        rows = table.rows(words)
        assert table.values[table.first[rows]].tolist() == [len(w) for w in text.split()]


def test_counts_are_those_of_a_unigram_model(spark, odd):
    from tokenizers import Tokenizer, models, pre_tokenizers

    path = public_tokenizers.path("piece_bpe_32k.model")
    vocabulary = token_counts.vocabulary_of(path)
    least = min(score for _, score in vocabulary)
    pieces = [("<unk>", least), *((f"<0x{i:02X}>", least) for i in range(256)), *vocabulary]
    library = Tokenizer(models.Unigram(pieces, unk_id=0, byte_fallback=True))
    library.pre_tokenizer = pre_tokenizers.Metaspace(replacement="\u2581", prepend_scheme="always", split=True)
    got = token_counts.count_tokens(odd, path).collect()
    assert len(got) == odd.count()
    for row in got:
        text = "one" if row.doc_id is None else TEXTS[row.doc_id] or ""
        assert row.n_tokens == len(library.encode(text).ids), text
        assert row.n_chars == len(text)


def test_ties_go_to_the_match_that_starts_first():
    viterbi = token_counts.CountOnlyViterbi([("a", -1.0), ("aa", -2.0), ("aaa", -3.0), ("b", -1.0)])
    assert [viterbi.count(x) for x in ("", "a", "aa", "aaa", "aab", "é")] == [0, 1, 1, 1, 2, 2]


@pytest.mark.parametrize("values", [[], [0], [5], [0, 0, 3, 3, 900], list(range(0, 7000, 7)), [0] * 130 + [10**12]])
def test_elias_fano_round_trip(values):
    coded = token_files.elias_fano(np.array(values, np.int64), values[-1] if values else 0)
    read = token_files.EliasFano(memoryview(coded))
    assert read.size == len(coded)
    assert read.all().tolist() == values
    assert [read.select(i) for i in range(len(values))] == values


def test_elias_fano_is_small():
    values = np.sort(np.random.default_rng(3).integers(0, 1 << 30, 10_000))
    assert len(token_files.elias_fano(values, int(values[-1]))) * 8 < 10_000 * (2 + 17 + 1)


def test_token_files(spark, odd):
    from tokenizers import Tokenizer

    path = public_tokenizers.path("word_bpe_49k.json")
    library = Tokenizer.from_file(path)
    location = token_files.write_token_files(odd, path, end_id=2)
    got = {(r.doc_id, r.start): r for r in token_files.read_token_files(spark, location, with_ids=True).collect()}
    rows = sorted(((r.doc_id, r.text) for r in odd.collect()), key=lambda r: (r[0] is not None, r[0] or 0))
    start = 0
    for doc_id, text in rows:
        ids = [*library.encode(text or "", add_special_tokens=False).ids, 2]
        row = got.pop((doc_id, start))
        assert (row.ids, row.n_tokens, row.ids_crc32) == (ids, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        start += len(ids)
    assert not got


def test_no_documents_at_all(spark, odd):
    none = odd.limit(0)
    path = public_tokenizers.path("word_bpe_49k.json")
    assert token_files.read_token_files(spark, token_files.write_token_files(none, path, 2)).count() == 0
    assert token_counts.count_tokens(none, public_tokenizers.path("piece_bpe_32k.model")).count() == 0


PAGE = (
    '<html><head><title>t</title><script>"</p>"</script></head><body class="has-sidebar"><header><h1>Site</h1></header><nav><a href=x>Home</a></nav>'
    '<div class="content"><h1>{title}</h1><p>{a} &amp; <b>bold<br>line<p>{b}&nbsp;end<ul><li>x{a}<li>y{b}</ul><!-- <p>no</p> --></div>'
    '<aside>side {a}</aside><div id="comments"><p>reader {b}</p></div><form>f</form><p>All rights reserved</p><footer>foot {a}</footer></body></html>'
)


def test_slots_of_a_host_are_its_text(spark):
    pages = [(i, f"http://h.org/{i}", PAGE.format(title=f"Title {i}", a=f"one{i}", b=f"two{i}")) for i in range(6)]
    article = "<body><article><h1>T</h1><p>same</p><div class=share>s</div></article><p>other</p></body>"
    pages += [(10 + i, "http://h.org/a", article) for i in range(5)]
    pages += [(20, None, None), (21, "no url", ""), (22, "http://h.org/x", "<p>unclosed <i>tags"), (20, None, None)]
    frame = spark.createDataFrame([(*p, "clash") for p in pages], "page_id long, url string, html string, host string")
    got = {r.page_id: r for r in html_extract.extract_text(frame).collect()}
    assert got[3].text == "Title 3\n\none3 & bold line\n\ntwo3 end\n\nxone3\n\nytwo3"
    assert got[12].text == "T\n\nsame" and got[12].n_chars == 7
    assert (got[20].text, got[21].text, got[20].n_chars) == ("", "", 0)
    assert got[22].text == "unclosed tags"
    assert html_extract.extract_text(frame).count() == len(pages)
    assert html_extract.extract_text(frame.limit(0)).count() == 0


@pytest.mark.parametrize(
    ("page", "text"),
    [
        ("<div class='page no-sidebar'><article><p>a<p>b</article></div>", "a\n\nb"),
        ("<article class=comment>c</article><main><article><header><h1>T</h1><p>by x</p></header>a &lt;b&gt; <em>c</em>d</article></main>", "T\n\na <b> cd"),
        ("<main>x<form>f</form><section class='related posts'>r</section>y<!-- z --></main>", "x\n\ny"),
        ("<article><table><tr><td>1</td><td>2</td></tr><tr><td>3<td>4</table></article>", "1 2\n\n3 4"),
        ("<article>a < b <p title='x>y'>c</article><script>1</script>", "a < b\n\nc"),
    ],
)
def test_articles(page, text):
    assert "\n\n".join(html_extract.article(html_extract.parse(page))) == text


def test_trees_match_in_order():
    a = [[0, "r", "", 0], [1, "x", "1", 0], [1, "y", "2", 0], [2, "z", "3", 0]]
    b = [[0, "r", "", 0], [1, "w", "0", 0], [1, "y", "2", 0], [2, "z", "4", 0], [1, "x", "1", 0]]
    assert sorted(html_extract.match_trees(a, b)) == [(0, 0), (2, 2), (3, 3)]
    assert html_extract.match_trees(a, [[0, "other", "", 0]]) == []


def test_long_and_deep_pages_without_an_article(spark):
    body = lambda page, n: [f"Page {page} says line {i} of its own." for i in range(n)]
    frame_of = lambda lines: "<html><body><div class=top>Our shop</div>" + "".join(f"<p>{x}</p>" for x in lines) + "<div class=end>All rights</div></body></html>"
    pages = {i: body(i, 2000 + 50 * i) for i in range(4)}
    deep = "<div>" * 3000 + "<p>Far below.</p>" + "</div>" * 3000 + "<p>And after.</p>"
    rows = [(i, "http://long.net/a", frame_of(lines)) for i, lines in pages.items()] + [(9, "http://deep.net/a", deep)]
    frame = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = {r.page_id: r.text for r in html_extract.extract_text(frame).collect()}
    assert got == {**{i: "\n\n".join(lines) for i, lines in pages.items()}, 9: "Far below.\n\nAnd after."}


def test_large_trees_match_from_both_ends(monkeypatch):
    tree = lambda n: [[0, "body", "", 0], [1, "nav", "n", 0], *([1, "p", f"{n}-{i}", 0] for i in range(n)), [1, "p", "end", 0]]
    monkeypatch.setattr(html_extract, "MOST_NODES", 3)
    pairs = html_extract.match_trees(tree(5), tree(8))
    assert {(0, 0), (1, 1), (7, 10)} <= set(pairs) and len(pairs) == 8


def test_size_does_not_change_how_trees_match(monkeypatch):
    """Unlike ends around many equal children, and random trees against the plain recursion."""
    wide = lambda first, n, last: [[0, "body", "", 0], [1, first, "", 0], *([1, "p", str(i), 0] for i in range(n)), [1, last, "", 0]]
    for n in (5, 700):
        assert sorted(html_extract.match_trees(wide("nav", n, "div"), wide("ul", n, "ol"))) == [(0, 0), *((i, i) for i in range(2, n + 2))]

    def most(a, b, i=0, j=0):
        if a[i][1] != b[j][1]:
            return 0
        below_a, below_b = html_extract._children(a), html_extract._children(b)
        best = {}
        for p, x in enumerate(below_a[i], 1):
            for q, y in enumerate(below_b[j], 1):
                best[p, q] = max(best.get((p - 1, q), 0), best.get((p, q - 1), 0), best.get((p - 1, q - 1), 0) + most(a, b, x, y))
        return 1 + max(best.values(), default=0)

    def tree(seed):
        draw = random.Random(seed)
        nodes = [[0, "r", "", 0]]
        for _ in range(draw.randint(0, 14)):
            nodes.append([draw.randint(1, min(3, nodes[-1][0] + 1)), draw.choice("xy"), draw.choice("12"), 0])
        return nodes

    for rows in (1, 2, 400):
        monkeypatch.setattr(html_extract, "MOST_NODES", rows)
        for seed in range(150):
            a, b = tree(seed), tree(seed + 1000)
            pairs = sorted(html_extract.match_trees(a, b))
            assert len(pairs) == most(a, b) and pairs == sorted(pairs, key=lambda p: p[1])
            assert all(a[i][:2] == b[j][:2] for i, j in pairs) and len({j for _, j in pairs}) == len(pairs)


def test_wrappers_choose_the_slots_of_pages_with_articles(spark):
    page = "<body><div class=a>Our shop</div><article><p>First {0}.</p></article><div class=b>Between {0}.</div><article><p>Second {0}, longer.</p></article><p>All rights reserved</p></body>"
    other = "<body><section><p>Only {0}.</p></section><p>Call us</p></body>"
    rows = [(i, "http://w.org/a", page.format(i)) for i in range(4)] + [(10 + i, "http://w.org/b", other.format(i)) for i in range(4)]
    rows += [(30, "http://alone.org/a", "<body><div>Once</div><main>Intro.<article><p>Body.</p></article></main></body>")]
    got = {r.page_id: r.text for r in html_extract.extract_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert got == {
        **{i: f"First {i}.\n\nBetween {i}.\n\nSecond {i}, longer." for i in range(4)},
        **{10 + i: f"Only {i}." for i in range(4)},
        30: "Intro.\n\nBody.",
    }
