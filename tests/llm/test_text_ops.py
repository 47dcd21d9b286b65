"""BPE, language ID, URL filters, quality rules and HTML against brute force and defined edge cases."""

import fnmatch
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from kintsugi.llm import bpe, html, langid, quality, urlfilter
from kintsugi.llm.queries import vocabulary_path
from kintsugi.llm.transducer import Transducer, compile_transducer
from tests.conftest import SF_SMALL

SCHEMA = "doc_id long, text string, lang string"
LONG = "Thé quick brown fox; " * 60_000


@pytest.fixture(scope="module")
def odd(spark):
    """Nulls, empty and long texts, repeated rows, and columns named like the results."""
    rows = [(1, None, "en"), (2, "", "en"), (None, "  \n\t ", None), (4, "12 34 !!", "en"), (5, "the of and <|endoftext|> the", "en"),
            (5, "the of and <|endoftext|> the", "en"), (6, LONG, "en"), (7, "los el la de que ñandú", "es")]
    df = spark.createDataFrame(rows, SCHEMA)
    return df.withColumns({c: F.lit(7) for c in ("ids", "decoded", "lang_pred", "score", "n_words", "kept", "html")})


def test_transducer_shares_ends_and_finds_only_its_words():
    words = {b"walking": (1, 9), b"talking": (2, 9), b"walks": (1, 4), b"walk": (1,), b"": (7, 7), b"balking": (9,)}
    t = Transducer(compile_transducer(words))
    assert [None if x is None else tuple(x.tolist()) for x in t.lookup([*words, b"wal", b"walkings", b"x"])] == [*words.values(), None, None, None]
    assert t.n_states < len({w[:i] for w in words for i in range(len(w) + 1)})
    rng = random.Random(3)
    many = {bytes(rng.choice(b"abc") for _ in range(rng.randint(0, 7))): tuple(rng.choices(range(5), k=rng.randint(0, 4))) for _ in range(800)}
    t = Transducer(compile_transducer(many))
    assert [tuple(x.tolist()) for x in t.lookup(list(many))] == list(many.values())
    assert Transducer(compile_transducer({})).lookup([b"a", b""]) == [None, None]


def test_bpe_equals_the_library():
    tokenizers = pytest.importorskip("tokenizers")
    library = tokenizers.Tokenizer.from_file(vocabulary_path())
    vocabulary = bpe.Vocabulary.load(vocabulary_path())
    encoder = bpe.Encoder(vocabulary, bpe.compile_lexicon(vocabulary, [" the", "ing", " it's", "\n\n"]))
    rng = random.Random(5)
    parts = ["'", "'s", "'re", "'ll", " ", "  ", "\n", "\t", "a", "the", " foo", "23", "!", "é", "日本", "\xa0", "\x1c", "\u0345", "\U0001f600",
             "<|endoftext|>", "'S", "²", "\x85", "\u3000", "_", "\U000105c5", "\U00010d41", "\u200b"]
    texts = ["".join(rng.choices(parts, k=rng.randint(0, 40))) for _ in range(3000)] + ["ab" * 400, "=-" * 900, "x" * 5000, ""]
    found = [np.frombuffer(x, np.int32).tolist() for x in encoder.encode(texts)]
    assert found == [library.encode(t, add_special_tokens=False).ids for t in texts]
    assert [bpe.decoded(x, vocabulary.pieces) for x in found] == texts


def test_bpe_on_odd_rows(spark, odd):
    tokenizer = bpe.Tokenizer(spark, vocabulary_path(), bpe.frequent_words(odd, least=2))
    rows = tokenizer.decode(tokenizer.encode(odd)).select("doc_id", "text", "ids", "decoded").collect()
    assert len(rows) == 8 and all(r.decoded == (r.text or "") for r in rows)
    assert [r.ids for r in rows if r.doc_id in (1, 2)] == [[], []]
    assert all(r.ids.count(50256) == 1 for r in rows if r.doc_id == 5)
    assert tokenizer.encode(odd.limit(0)).count() == 0 and bpe.frequent_words(odd.limit(0)) == []


def test_language_accuracy_on_held_out_rows(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    model = langid.train(docs.where(langid.fold() != 2))
    rows = langid.predict(docs.where(langid.fold() == 2), model).collect()
    assert np.mean([r.lang == r.lang_pred for r in rows]) > 0.95 and all(0 <= r.score <= 1 for r in rows)


def test_language_of_odd_rows(odd):
    model = langid.train(odd)
    rows = langid.predict(odd, model).collect()
    assert [r.lang_pred == "und" for r in rows] == [True] * 4 + [False] * 4
    assert all((r.score == 0) == (r.lang_pred == "und") for r in rows)
    empty = langid.train(odd.where("lang is null"))
    assert {r.lang_pred for r in langid.predict(odd, empty).collect()} == {"und"}
    with pytest.raises(ValueError):
        langid.train(odd, max_languages=1)


def test_texts_in_a_language_left_out_are_rejected(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").where("length(text) > 200")
    for left_out in ("de", "en", "es", "fr"):
        labelled = docs.where((F.col("lang") != left_out) & (langid.fold() != 2))
        model = langid.with_limits(labelled, langid.train(labelled))
        rows = langid.predict(docs, model).withColumn("out", langid.rejects()).collect()
        assert np.mean([r.out for r in rows if r.lang == left_out]) > 0.9
    labelled = docs.where(langid.fold() != 2)
    model = langid.with_limits(labelled, langid.train(labelled))
    assert langid.predict(docs, model).where(langid.rejects()).count() == 0
    nothing = docs.limit(0)
    assert langid.predict(docs, langid.with_limits(nothing, langid.train(nothing))).where(~langid.rejects()).count() == 0


def test_globs_equal_a_plain_matcher():
    rng = random.Random(1)
    globs = ["".join(rng.choices(["a", "b", "/", ".", "*", "**", "?"], k=rng.randint(1, 9))) for _ in range(120)]
    urls = ["".join(rng.choices("ab/.", k=rng.randint(0, 12))) for _ in range(400)] + ["", "a" * 300]

    def plain(glob):
        parts = re.split(r"(\*\*|\*|\?)", glob)
        return re.compile("".join({"**": ".*", "*": "[^/]*", "?": "."}.get(p, re.escape(p)) for p in parts) + r"\Z", re.S)

    merged = [re.sub(r"\*{3,}", "**", g) for g in globs]
    tests = [plain(g) for g in merged]
    want = [next((k for k, t in enumerate(tests) if t.match(u)), -1) for u in urls]
    assert urlfilter.GlobSet(merged).first_match([u.encode() for u in urls]).tolist() == want


def test_url_rules(spark):
    cases = {"http://EXAMPLE.com/en/1?x": ("example.com", "/en/1", "example.com/en/", "block"),
             "https://www.example.com/en/": ("www.example.com", "/en/", "www.example.com/en/", "allow"),
             "https://a.example.com/fr": ("a.example.com", "/fr", "com/", "allow"),
             "http://notexample.com/en/": ("notexample.com", "/en/", "com/", "allow"),
             "http://x.net/es/1": ("x.net", "/es/1", "net/es/", "block"), "http://com": ("com", "", None, "allow"),
             "http://spam.org/a": ("spam.org", "/a", None, "block"), "http://a.org/b.exe#f": ("a.org", "/b.exe", None, "block"),
             "http://evil.org/x.example.com/en/": ("evil.org", "/x.example.com/en/", None, "allow"),
             "mailto:x": ("", "", None, "allow"), None: ("", "", None, "allow"), "x://h:80/é?": ("h:80", "/é", None, "allow")}
    df = spark.createDataFrame([(u, 1) for u in cases], "url string, host int")
    got = {r.url: (r.host, r.path, r["rule"], r.verdict) for r in urlfilter.judge(df).collect()}
    assert got == cases
    assert urlfilter.judge(df.limit(0)).count() == 0
    assert fnmatch  # the plain matcher above replaces it: it has no two kinds of star


def _base(text):
    words, cover, seen, repeated, where = re.findall(r"[^\x20\x09-\x0D]+", text), set(), set(), 0, {}
    for i in range(len(words) - 2):
        where.setdefault(tuple(words[i:i + 3]), []).append(i)
    for at in where.values():
        if len(at) > 1:
            cover |= {i + k for i in at for k in range(3)}
    for line in text.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            repeated += line in seen
            seen.add(line)
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), repeated, len(cover)


def test_quality_equals_brute_force():
    rng = random.Random(2)
    texts = ["".join(rng.choices(["a", "b ", "c\n", " ", "#", "é|", "\u2028", "a b c ", "\t"], k=rng.randint(0, 60))) for _ in range(400)]
    got = quality.measure(texts)
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    assert list(zip(*[got[n].tolist() for n in names], strict=True)) == [_base(t) for t in texts]
    for i, t in enumerate(texts):
        words = re.findall(r"[^\x20\x09-\x0D]+", t)
        seen, cover = set(), set()
        for k in range(len(words) - 4):
            w = tuple(words[k:k + 5])
            if w in seen:
                cover |= set(range(k, k + 5))
            seen.add(w)
        share = sum(len(words[k]) for k in cover) / max(1, sum(map(len, words)))
        assert abs(got["dup_5gram_share"][i] - share) < 1e-12


def test_quality_of_odd_rows(odd):
    rows = quality.rate(odd).collect()
    assert [r.n_words for r in rows][:4] == [0, 0, 0, 3] and not any(r.kept for r in rows)
    plain = " ".join(f"w{i}" for i in range(80))
    assert quality.measure([plain])["kept"][0] and not quality.measure([plain + "\n" + plain])["kept"][0]
    assert quality.rate(odd.limit(0)).count() == 0


def test_html_layout():
    page = """<html><head><title>no</title></head><body><p>One<p>Two <b>bold</b>text<div>D<ul><li>a<li>b<ul><li>c</ul></ul></div>
      <table><tr><th>Name<th>Val<tr><td>alpha<td>1<tr><td rowspan=2>x<td>y<tr><td>z</table><pre> a
  b</pre><ol start=3><li>x<li>y</ol><p hidden>q</p><span style="color:red; display : none">q</span>a &lt; b < c<br>n
      <details>no<summary>sum</summary>no</details><script>var x="</p>"</script><a href="x>y">link</a> <unfinished"""
    assert html.render(page) == ("One\n\nTwo boldtext\n\nD\n\n  - a\n  - b\n    - c\n\nName   Val\nalpha  1\nx      y\n       z\n\n a\n  b\n\n"
                                 "  3. x\n  4. y\n\na < b < c\nn\nsum\nlink")


def test_html_head_and_body_tags_may_be_omitted():
    head = "<html><head><title>t</title><meta charset=x><style>p {}</style>\n"
    for page in (head + "<p>Text <b>here", head + "Text <b>here", "<title>t</title><p>Text <b>here", head + "<noscript>no</noscript><body>Text <b>here",
                 "<head><script>var a = '<p>no'</script>Text <b>here</b>"):
        assert html.render(page) == "Text here"
    assert html.render(head + "<div>A</div><head><p>B</p></head>C") == "A\n\nB\n\nC"
    assert html.render(head + "</head><body>x") == "x"


def test_html_text_in_images_and_formulas():
    page = """<p>See <svg viewBox="0 0 1 1"><title>no</title><defs/><defs><text>no</text></defs><style>no</style><g>no<path d="M0"/>
      <text x=1>North</text><text>So<tspan>uth</tspan><desc>no</desc></text><text display="none">no</text></g>
      <foreignObject><p>inside</foreignObject></svg> and <math><mi>x</mi><mo>=</mo><semantics><mn>2</mn><annotation>no</annotation></semantics></math>.
      <svg hidden><text>no</text></svg><svg><text>open<p>After</p><math><mi>y<p>last"""
    assert html.render(page).split() == "See North South inside and x=2. open After y last".split()
    assert html.render('<svg><title/><text>a</text></svg>b') == "a b"


def test_html_of_odd_rows(spark):
    pages = [None, "", "plain", "<p>" * 3000 + "x", "<table><tr><td>" * 500 + "deep", "<a b='", "<!-- open", "<td>stray</td>", "<" * 9, LONG]
    df = spark.createDataFrame([(i, p, 1) for i, p in enumerate(pages)], "page_id long, html string, text int")
    got = [r.text for r in html.extract(df).orderBy("page_id").collect()]
    assert got == ["", "", "plain", "x", "deep", "", "", "stray", "<" * 9, LONG.strip()]
