"""Jaccard join, line dedup, decontamination, substrings, personal data and the pipeline: brute force and edges."""

import itertools
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from kintsugi.llm import common, decontam, jaccard, linededup, pii, substrings

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def _words(rng, n, kinds=400):
    return [f"w{rng.randrange(kinds)}" for _ in range(n)]


def _mutated(rng, words, edits):
    out = list(words)
    for _ in range(edits):
        i = rng.randrange(len(out))
        out[i:i + 1] = rng.choice([[], [f"new{rng.randrange(10**6)}"], [out[i], f"more{rng.randrange(10**6)}"]])
    return out


@pytest.fixture(scope="module")
def corpus(spark):
    """Groups of near and exact copies, a shared passage, short texts, nulls, repeated rows and ids."""
    rng = random.Random(11)
    passage = _words(rng, 60)
    texts = []
    for _ in range(12):
        base = _words(rng, rng.choice([20, 60, 200]))
        texts += [" ".join(_mutated(rng, base, rng.randint(0, 4))) for _ in range(8)] + [" ".join(base)] * 2
    texts += [" ".join(_words(rng, 40) + passage + _words(rng, 40)) for _ in range(30)]
    texts += ["a b", "A  b", "a b c d e", "A B C D E f", "", " \n ", None, "one", None]
    rows = [(i, t) for i, t in enumerate(texts)] + [(3, texts[3]), (None, texts[5]), (7, "another text under a used id " * 3)]
    return spark.createDataFrame([(i, t, "x", 1, 2) for i, t in rows], "doc_id long, text string, k string, n_shingles int, set_key int"), rows


def _sets(rows):
    low = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    out = []
    for _, t in rows:
        w = WORD.findall((t or "").translate(low))
        out.append(frozenset(tuple(w[i:i + 5]) for i in range(len(w) - 4)) if len(w) > 4 else frozenset([tuple(w)] if w else []))
    return out


def _brute_components(rows):
    sets, label = _sets(rows), list(range(len(rows)))

    def root(i):
        while label[i] != i:
            i = label[i]
        return i

    for i, j in itertools.combinations(range(len(rows)), 2):
        both = len(sets[i] & sets[j])
        if both and 100 * both >= 75 * (len(sets[i]) + len(sets[j]) - both):
            label[root(j)] = root(i)
    groups = {}
    for i in range(len(rows)):
        groups.setdefault(root(i), []).append(i)
    return sets, list(groups.values())


def test_jaccard_join_equals_brute_force(corpus):
    df, rows = corpus
    sets, groups = _brute_components(rows)
    want = []
    for g in groups:
        ids = [rows[i][0] for i in g if rows[i][0] is not None]
        want += [(rows[i][0], len(sets[i]), min(ids) if ids and sets[i] else rows[i][0]) for i in g]
    got = [tuple(r) for r in jaccard.join(df).collect()]
    key = lambda r: tuple((x is None, x or 0) for x in r)
    assert sorted(got, key=key) == sorted(want, key=key)
    assert any(len(g) > 4 for g in groups)


def test_one_row_of_each_group_stays(corpus):
    df, rows = corpus
    sets, groups = _brute_components(rows)
    kept = jaccard.representatives(df)
    assert kept.columns == df.columns
    assert kept.count() == sum(1 if sets[g[0]] else len(g) for g in groups)
    assert jaccard.representatives(df.limit(0)).count() == 0 and jaccard.join(df.limit(0)).count() == 0


def test_connected_follows_long_chains(spark):
    chain = [(i, i + 1) for i in range(60)] + [(100, 200), (200, 100), (300, 300)]
    got = {r.node: r.label for r in common.connected(spark.createDataFrame(chain, "a long, b long")).collect()}
    assert got == {i: 0 for i in range(61)} | {100: 100, 200: 100}


def _within_one(a, b):
    if abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) <= 1
    a, b = sorted((a, b), key=len)
    return any(b[:i] + b[i + 1:] == a for i in range(len(b)))


@pytest.fixture(scope="module")
def lined(spark):
    rng = random.Random(4)
    bases = ["".join(rng.choices("abé ", k=rng.randint(5, 40))) for _ in range(25)]

    def line():
        s = rng.choice(bases)
        for _ in range(rng.choice([0, 0, 1, 1, 2])):
            i = rng.randrange(len(s))
            s = s[:i] + rng.choice(["", "x", s[i] + "a"]) + s[i + 1:]
        return rng.choice([s, s, s, "", "  "])

    rows = [(rng.choice([i, i, None]), "\n".join(line() for _ in range(rng.randint(0, 6)))) for i in range(60)]
    rows += [(9, None), (10, ""), rows[0], rows[0], (500, "z" * 90_000 + "\n" + "z" * 90_000)]
    return spark.createDataFrame([(i, t, 1, 2) for i, t in rows], "doc_id long, text string, n_lines int, k int"), rows


def test_line_dedup_equals_brute_force(spark, lined):
    df, rows = lined
    r = {(x.doc_id, x.text): x.r for x in df.select("doc_id", "text", linededup._row_hash("doc_id", "text").alias("r")).collect()}
    lines = [((i is None, i or 0, r[i, t], n), s) for i, t in set(rows) if t is not None for n, s in enumerate(t.split("\n"))]

    def dropped(place, line):
        return bool(WORD.search(line)) and any(p < place and (s == line or (min(len(s), len(line)) >= linededup.MIN_FUZZY and _within_one(s, line)))
                                               for p, s in lines)

    want = []
    for i, t in rows:
        keep = None if t is None else [s for n, s in enumerate(t.split("\n")) if not dropped((i is None, i or 0, r[i, t], n), s)]
        total = 0 if t is None else t.count("\n") + 1
        want.append((i, None if t is None else "\n".join(keep), total, total - len(keep or [])))
    got = [(x.doc_id, x.text, x.n_lines, x.n_dropped) for x in linededup.dedup(df).collect()]
    assert sorted(got, key=str) == sorted(want, key=str)
    assert sum(x[3] for x in want) > 20
    assert linededup.dedup(df.limit(0)).count() == 0


def test_edit_distances_equal_the_plain_recursion():
    rng = np.random.default_rng(1)
    pairs = [(rng.integers(0, 3, 8), rng.integers(0, 3, rng.integers(0, 12))) for _ in range(200)]

    def plain(a, b):
        row = list(range(len(b) + 1))
        for i, x in enumerate(a, 1):
            new = [i]
            for j, y in enumerate(b, 1):
                new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
            row = new
        return min(row)

    assert decontam.edit_distances([a for a, _ in pairs], [b for _, b in pairs]).tolist() == [plain(a, b) for a, b in pairs]


def test_decontamination_finds_edited_passages(spark):
    rng = random.Random(8)
    items = [(i, _words(rng, rng.choice([6, 16, 30, 59]), 10**6)) for i in range(40)]
    docs, planted = [], set()
    for d in range(300):
        text = _words(rng, 120, 10**6)
        if d % 2:
            i, words = items[d % len(items)]
            passage = _mutated(rng, words, decontam.edits_allowed(len(words), decontam.SHARE))
            at = rng.choice([0, 60, 120])
            text[at:at] = passage
            planted.add((d, i))
        docs.append((d, " ".join(text).upper() if d % 3 else " ,".join(text), 0))
    docs += [(900, None, 0), (901, "", 0), (902, " ".join(items[0][1]), 0), (902, " ".join(items[0][1]), 0), (None, " ".join(items[1][1]), 0)]
    bench = spark.createDataFrame([(i, " ".join(w)) for i, w in items] + [(77, None), (78, "..."), (79, " ".join(items[0][1]))], "item_id long, text string")
    df = spark.createDataFrame(docs, "doc_id long, text string, place int")
    got = [(r.id, r.item) for r in decontam.find(df, bench).collect()]
    assert len(got) == len(set(got)) and {(902, 0), (902, 79), (None, 1)} <= set(got)
    found = {x for x in got if x[0] is not None and x[0] < 900 and x[1] < 77}
    assert found <= planted and len(found) >= 0.9 * len(planted)
    kept = decontam.clean(df, bench)
    assert kept.columns == df.columns and {900, 901} <= {r.doc_id for r in kept.collect()} and kept.count() == len(docs) - len(found) - 3
    assert decontam.find(df, bench.limit(0)).count() == 0 and decontam.clean(df.limit(0), bench).count() == 0


def _brute_removed(texts):
    seen = {}
    for t in texts:
        for i in range(len(t) - 199):
            seen[t[i:i + 200]] = seen.get(t[i:i + 200], 0) + 1
    out = []
    for t in texts:
        gone = np.zeros(len(t), bool)
        for i in range(len(t) - 199):
            if seen[t[i:i + 200]] > 1:
                gone[i:i + 200] = True
        runs = int(np.diff(np.concatenate(([0], gone.astype(int)))).clip(0).sum())
        out.append((len(t), int(gone.sum()), runs, np.frombuffer(t, np.uint8)[~gone].tobytes()))
    return out


@pytest.mark.parametrize("pool_rows", [substrings.POOL_ROWS, 1])
def test_repeated_substrings_equal_brute_force(spark, pool_rows):
    rng = random.Random(21)
    piece = lambda n: "".join(rng.choices("abcdé ", k=n))
    shared = [piece(n) for n in (150, 199, 200, 201, 260, 500)]
    texts = [piece(rng.randint(0, 300)) + rng.choice(shared) + piece(rng.randint(0, 200)) + rng.choice(["", *shared]) for _ in range(40)]
    texts += [shared[2], "ab" * 300, "x" * 201, "x" * 199, piece(900)] + [texts[0]] * 3 + ["", None, piece(100)]
    texts += ["".join(c if rng.random() > 0.01 else "!" for c in texts[1]) for _ in range(15)]
    df = spark.createDataFrame([(i, t, 3) for i, t in enumerate(texts)], "doc_id long, text string, n_spans int")
    got = [(r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in substrings.dedup(df, pool_rows=pool_rows).orderBy("doc_id").collect()]
    assert got == _brute_removed([(t or "").encode() for t in texts])
    assert substrings.dedup(df.limit(0)).count() == 0


def test_bwt_groups_equal_sorted_prefixes():
    rng = np.random.default_rng(6)
    symbols = np.concatenate([np.append(rng.integers(10, 13, rng.integers(1, 60)), k) for k in range(8)])
    for depth in (1, 3, 6):
        rows, group, longer = substrings.bounded_groups(symbols, depth)
        assert sorted(rows.tolist()) == list(range(len(symbols)))
        for width, found in ((depth, group), (depth + 1, longer)):
            prefix = [tuple(np.concatenate((symbols, -np.arange(1, 9)))[i:i + width]) for i in rows.tolist()]
            inner = [p == q for p, q in zip(prefix, prefix[1:], strict=False)]
            assert [a == b for a, b in zip(found, found[1:], strict=False)] == inner


def _brute_spans(text):
    plain = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
             "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}
    digits = lambda v: re.sub("[^0-9]", "", v)

    def luhn(d):
        return sum(int(c) if i % 2 == 0 else (2 * int(c) - 9 * (int(c) > 4)) for i, c in enumerate(reversed(d))) % 10 == 0

    tests = {"email": lambda v: True, "ip": lambda v: all(int(p) <= 255 for p in v.split(".")),
             "card": lambda v: 14 <= len(digits(v)) <= 19 and luhn(digits(v)), "phone": lambda v: 10 <= len(digits(v)) <= 15}
    return sorted((m.start(), i, m.end()) for i, k in enumerate(plain) for m in re.finditer(plain[k], text) if tests[k](m.group()))


def test_personal_data_equals_brute_force(spark):
    rng = random.Random(13)
    parts = ["a@b.c", ".", "@", "x_1", "1.2.3.4", "256.1.1.1", "001.2.3.255", "+1 (743) 555-3824", "4111 1111 1111 1111", "4111111111111112",
             " ", "\n", "é", "\U0001f600", "-", "1", "22", "+", "a.b-c@d-e.f.g", ".c@d.e", "%+", "(", "30569309025904"]
    texts = ["".join(rng.choices(parts, k=rng.randint(0, 25))) for _ in range(300)]
    texts += ["", "a" * 30_000, "1 " * 20_000, "1.2.3.4 " * 700, "a@" * 9000, "+1(" * 5000, "x@y.z " * 600]
    df = spark.createDataFrame([(i, t, 1) for i, t in enumerate(texts)] + [(1000, None, 1), (0, texts[0], 1)], "doc_id long, text string, spans int")
    rows = pii.sanitise(df).orderBy("doc_id").collect()
    assert [sorted((s.start, s.kind, s.end) for s in r.spans if s.kind < 4) for r in rows] == \
        [_brute_spans(t) for t in [texts[0], *texts]] + [[]]
    assert pii.sanitise(df.limit(0)).count() == 0


def test_terms_that_give_an_identifier_away(spark):
    other = [(100 + i, f"plain words about nothing much number{i}") for i in range(200)]
    told = [(i, f"write to Zanzibarov at zan@corp.example today, sample {i}") for i in range(4)]
    common_word = [(50 + i, f"plain mail to p{i}@corp.example today") for i in range(4)]
    df = spark.createDataFrame(other + told + common_word, "doc_id long, text string")
    found = pii.sanitise(df)
    marked = found.join(df, "doc_id").select("doc_id", "text", "spans", pii.redacted(F.col("text"), F.col("spans")).alias("clean"))
    rows = {r.doc_id: r for r in marked.collect()}
    for i in range(4):
        assert any(rows[i].text[s.start:s.end] == "Zanzibarov" and s.kind >= 4 for s in rows[i].spans)
        assert "Zanzibarov" not in rows[i].clean and "[EMAIL]" in rows[i].clean
        assert len(rows[50 + i].spans) == 1
    assert all(not rows[100 + i].spans and rows[100 + i].clean == rows[100 + i].text for i in range(200))


def test_disclosing_terms_are_marked_wherever_they_occur(spark):
    filler = "plain words about nothing much " * 60
    told = [(i, f"write Zanzibarov or Li or Smith-Jones by zan@corp.example, {filler}then ZANZIBAROV \U0001f600 and Smith-Jones.") for i in range(9)]
    told += [(9, f"{filler}Zanzibarov was there"), (10, f"x@corp.example, zan@corp.example {filler}")]
    pairs = [(20 + i, f"Quillerman sent a{i}@b.example, two@b.example on") for i in range(4)]
    df = spark.createDataFrame(told + pairs + [(100 + i, f"{filler}number{i}") for i in range(400)], "doc_id long, text string")
    rows = {r.doc_id: r for r in pii.sanitise(df).join(df, "doc_id").collect()}
    marked = {d: [r.text[s.start:s.end] for s in r.spans if s.kind >= 4] for d, r in rows.items()}
    for i in range(9):
        assert marked[i].count("Zanzibarov") == marked[i].count("ZANZIBAROV") == marked[i].count("Li") == 1 and marked[i].count("Smith-Jones") == 2
        assert "Quillerman" not in marked[i] and not {"plain", "words"} & set(marked[i])
    assert marked[9] == ["Zanzibarov"]
    assert all("Quillerman" in marked[20 + i] for i in range(4))
    assert not any(marked[100 + i] for i in range(400))


def test_personal_data_stays_in_the_jvm(spark):
    df = spark.createDataFrame([(1, "a@b.c")], "doc_id long, text string")
    plan = pii.sanitise(df)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


def test_pipeline_stages(spark, tmp_path):
    import corpus_pipeline
    from tests.conftest import SF_SMALL
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    item = spark.read.parquet(f"{SF_SMALL}/benchmark.parquet").first().text
    extra = [(10**6, None, None, None, None), (10**6 + 1, "", "en", "s", 0), (10**6 + 2, f"Clean start here. {item}", "en", "s", 9),
             (10**6 + 2, f"Clean start here. {item}", "en", "s", 9)]
    docs = docs.unionByName(spark.createDataFrame(extra, docs.schema))
    for name, stage in corpus_pipeline.STAGES:
        before, docs = docs, common.stored(stage(spark, docs, SF_SMALL))
        assert name == "bpe" or docs.columns == before.columns
        assert 0 < docs.count() <= before.count()
    assert docs.where("not round_trip or doc_id >= 1000000").count() == 0
    assert corpus_pipeline.run(spark, SF_SMALL).count() > 100
    empty = spark.read.parquet(f"{SF_SMALL}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        empty = stage(spark, empty, SF_SMALL)
    assert empty.count() == 0


def test_every_operator_is_registered():
    import __spark_entry__ as entry
    names = set(entry.queries())
    assert {f"op{n}" for n in range(1, 14)} == {x.split("_")[0] for x in names if re.match(r"op\d+_", x)} and "pipeline" in names
