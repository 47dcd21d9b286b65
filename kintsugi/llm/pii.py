"""Personal data: direct identifiers, and the terms that give them away.

Direct identifiers (base spans) are found by patterns: email, ip, card, phone.
Each distinct identifier is a protected entity.  Information theory then tells
which words near it disclose it: over all documents of the corpus,

    IC(e) = -log2 p(e),   PMI(t; e) = log2 (p(t, e) / (p(t) p(e))),

and the disclosure PMI / IC is 1 for a term that never occurs without the entity
nearby.  Terms of a context with enough support are generalised from
``GENERALISE`` on and removed from ``REMOVE`` on, wherever they occur in any text.

Everything runs as DataFrame expressions: patterns, offsets (prefix sums over
the pieces between matches), checksums, counts and joins.  The patterns use
possessive loops, so texts of any length need neither backtracking nor stack.

Defined results: a null text counts as empty and has no spans.  Identifiers
that occur in fewer than ``SUPPORT`` different documents disclose nothing by
their context.  Repeated rows (equal id and text) are one document and get equal
results; rows that share only the id are told apart by a hash of their text.
Extra columns do not matter.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kintsugi.llm.common import stored, text_of

#: Kinds in the order in which spans with equal beginnings are listed.
KINDS = ("email", "ip", "card", "phone", "remove", "generalise")
#: Patterns with possessive loops; an email begins where its run of characters does, or where the match before ended.
PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?+[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
IP_PARTS = r"^0*(25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])(\.0*(25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])){3}$"
#: A term: letters, also joined by hyphens, that are no part of an address or number.
TERM = r"(?<![\p{L}\p{N}@._%+-])\p{L}++(?:-\p{L}++)*+(?![@_%+\p{N}-]|\.[\p{L}\p{N}])"

#: A term of a context: one more character stands before it and two after it, so cut words are none.
CONTEXT_TERM = rf"(?<=[\s\S]){TERM}(?=[\s\S]{{2}})"

#: Characters of context on either side of an identifier.
CONTEXT = 60
#: Documents that must hold a term near an identifier.
SUPPORT = 3
GENERALISE = 0.85
REMOVE = 0.95
_CHUNK = 256
#: Characters of the pieces from which contexts are cut.
_SEGMENT = 1024
#: Slots (2^bits) of the filter for disclosing terms.
_TERM_BITS = 18


def kept(value: Column) -> Column:
    # named twice, a computed array stays a column of its own; named once inside a
    # lambda, the optimizer would compute it again for every element
    return F.coalesce(value, value)


def _located(df: DataFrame, found: dict[str, tuple[Column, str]], wanted: Callable[[Column], Column] | None = None) -> DataFrame:
    """Adds for each name the array of matches of a pattern in a text column, as structs
    (start, value): offset and match (of those that are wanted).
    Offsets are prefix sums in chunks, so they cost little even for many matches."""
    def total(xs: Column) -> Column:
        return F.aggregate(xs, F.lit(0), lambda a, x: a + x)

    def piece(k: str, i: Column) -> Column:
        return F.col(f"p_{k}")[i]

    def lengths(k: str) -> Column:
        return F.transform(f"m_{k}", lambda x, i: F.length(x) + F.length(piece(k, i)))

    def chunks(k: str) -> Column:
        every = F.sequence(F.lit(0), F.floor(F.size(f"l_{k}") / _CHUNK).cast("int"))
        return F.transform(every, lambda c: total(F.slice(f"l_{k}", c * _CHUNK + 1, F.lit(_CHUNK))))

    def offsets(k: str) -> Column:
        return F.transform(f"c_{k}", lambda x, c: total(F.slice(f"c_{k}", F.lit(1), c)))

    def start(k: str, i: Column) -> Column:
        chunk = F.floor(i / _CHUNK).cast("int")
        return kept(F.col(f"o_{k}")[chunk]) + total(kept(F.slice(f"l_{k}", chunk * _CHUNK + 1, i - chunk * _CHUNK))) \
            + F.length(piece(k, i))

    def located(k: str) -> Column:
        if wanted:
            some = F.filter(F.transform(f"m_{k}", lambda x, i: F.struct(x.alias("value"), i.alias("i"))), lambda y: wanted(y["value"]))
            return F.transform(some, lambda y: F.struct(start(k, y["i"]).alias("start"), y["value"].alias("value")))
        return F.transform(f"m_{k}", lambda x, i: F.struct(
            start(k, i).alias("start"), x.alias("value")))

    names = list(found)
    df = df.withColumns({f"m_{k}": F.regexp_extract_all(text, F.lit(p), F.lit(0)) for k, (text, p) in found.items()})
    df = df.withColumns({f"p_{k}": F.when(F.size(f"m_{k}") > 0, F.split(text, p, -1)) for k, (text, p) in found.items()})
    for prefix, column in (("l", lengths), ("c", chunks), ("o", offsets)):
        df = df.withColumns({f"{prefix}_{k}": column(k) for k in names})
    return df.withColumns({k: located(k) for k in names}).drop(*[f"{c}_{k}" for c in "mplco" for k in names])


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _luhn(value: Column) -> Column:
    """Whether the digits pass the Luhn checksum."""
    digits = _digits(value)
    n = F.length(digits)

    def weigh(i: Column) -> Column:
        d = F.substr(digits, n - i + 1, F.lit(1)).cast("int")
        return F.when(i % 2 == 1, d).otherwise(2 * d - F.when(d > 4, 9).otherwise(0))

    return F.aggregate(F.sequence(F.lit(1), n), F.lit(0), lambda a, i: a + weigh(i)) % 10 == 0


def _valid(kind: str, value: Column) -> Column:
    if kind == "ip":
        return value.rlike(IP_PARTS)
    if kind == "card":
        return F.when(F.length(_digits(value)).between(14, 19), _luhn(value)).otherwise(False)
    if kind == "phone":
        return F.length(_digits(value)).between(10, 15)
    return F.lit(True)


def base_spans(df: DataFrame, text_col: str = "text") -> DataFrame:
    """``df`` with ``base``: (start, kind, end, value, around), in order; ``around`` is the span with its
    context, one more character before it and two after it (blanks beyond the text's ends)."""
    text = F.col("__text")
    hints = {"email": F.instr(text, "@") > 0, "phone": F.instr(text, "+") > 0}
    named = df.withColumn("__text", text_of(text_col))
    located = _located(named, {f"__{k}": (F.when(hints[k], text).otherwise("") if k in hints else text, p) for k, p in PATTERNS.items()})

    def spans(i: int, kind: str) -> Column:
        return F.transform(F.filter(f"__{kind}", lambda x: _valid(kind, x["value"])), lambda x: F.struct(
            x["start"].alias("start"), F.lit(i).alias("kind"), (x["start"] + F.length(x["value"])).alias("end"), x["value"].alias("value")))

    def around(x: Column) -> Column:
        at = F.greatest(x["start"] - CONTEXT - 1, F.lit(0))
        first = F.floor(at / _SEGMENT).cast("int")
        last = F.floor((x["end"] + CONTEXT + 2) / _SEGMENT).cast("int")
        part = F.substr(F.array_join(F.slice(kept(F.col("__segments")), first + 1, last - first + 1), ""),
                        at - first * _SEGMENT + 1, x["end"] + CONTEXT + 2 - at)
        size = F.least(x["start"], F.lit(CONTEXT)) + 1 + x["end"] - x["start"] + CONTEXT + 2
        return F.struct(x["start"].alias("start"), x["kind"].alias("kind"), x["end"].alias("end"), x["value"].alias("value"),
                        F.rpad(F.concat(F.when(x["start"] <= CONTEXT, " ").otherwise(""), part), size, F.lit(" ")).alias("around"))

    parts = [spans(i, kind) for i, kind in enumerate(PATTERNS)]
    sorted_ = located.withColumn("__spans", F.array_sort(F.concat(*parts))).drop(*[f"__{k}" for k in PATTERNS])
    cut = sorted_.withColumn("__segments", F.when(F.size("__spans") > 0, F.regexp_extract_all(text, F.lit(rf"(?s).{{1,{_SEGMENT}}}+"), F.lit(0))))
    return cut.withColumn("base", F.transform("__spans", around)).drop("__text", "__spans", "__segments")


def _context_terms(mentions: DataFrame) -> DataFrame:
    """(r, entity, term) of the terms that lie within ``CONTEXT`` characters of a mention."""
    return _rows_of(mentions, _terms_of(F.col("m.around"), CONTEXT_TERM), "term", "r", "entity").distinct()


def _rows_of(df: DataFrame, array: Column, name: str, *others: str) -> DataFrame:
    """One row per element.  From a plain ``explode`` the optimizer infers a filter on the array's size and moves it
    below the projections, where it holds the whole computation of the array a second time, patterns inside lambdas
    included; it infers none from the outer form."""
    return df.select(*others, F.explode_outer(array).alias(name)).where(F.col(name).isNotNull())


def _terms_of(text: Column, pattern: str = TERM) -> Column:
    return F.array_distinct(F.transform(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), F.lower))


def _occurrences(docs: DataFrame, terms: DataFrame) -> DataFrame:
    """(id, r, start, end, kind) of every occurrence of the terms (term, kind) in the texts of ``docs``.
    A table of bits picks the texts and words that may be wanted before the join on the term."""
    slot = F.xxhash64("term").bitwiseAND((1 << _TERM_BITS) - 1)
    got = terms.select(slot.alias("slot")).select(F.expr("slot div 64").alias("word"), F.expr("shiftleft(1L, cast(slot % 64 as int))").alias("bit")) \
        .groupBy("word").agg(F.bit_or("bit").alias("bits")).collect()
    words = [0] * (1 << _TERM_BITS - 6)
    for r in got:
        words[r["word"]] = r["bits"]
    table = F.split(F.lit(",".join(map(str, words))), ",").cast("array<bigint>")

    def may(term: Column) -> Column:
        h = F.xxhash64(term)
        word = F.shiftright(h, 6).bitwiseAND((1 << _TERM_BITS - 6) - 1).cast("int")
        return F.get(table, word).bitwiseAND(F.call_function("shiftleft", F.lit(1).cast("bigint"), h.bitwiseAND(63).cast("int"))) != 0

    some = docs.where(F.exists(_terms_of(F.col("text")), may))
    found = _located(some, {"terms": (F.col("text"), TERM)}, lambda value: may(F.lower(value)))
    every = _rows_of(found, F.col("terms"), "t", "id", "r") \
        .select("id", "r", F.lower("t.value").alias("term"), F.col("t.start").alias("start"), (F.col("t.start") + F.length("t.value")).alias("end"))
    return every.join(terms, "term").select("id", "r", "start", "end", "kind").distinct()


def disclosing_terms(near: DataFrame, mentions: DataFrame, docs: DataFrame, text_col: str) -> DataFrame:
    """(entity, term, disclosure) of the pairs with enough support whose disclosure reaches a threshold."""
    together = near.select("entity", "term", "r").distinct().groupBy("entity", "term").agg(F.count(F.lit(1)).alias("n_both")) \
        .where(F.col("n_both") >= SUPPORT)
    with_entity = mentions.select("entity", "r").distinct().groupBy("entity").agg(F.count(F.lit(1)).alias("n_entity"))
    words = _rows_of(docs, _terms_of(text_of(text_col)), "term")
    with_term = words.groupBy("term").agg(F.count(F.lit(1)).alias("n_term")).where(F.col("n_term") >= SUPPORT)
    n = docs.agg(F.count(F.lit(1)).alias("n")).scalar()
    share = lambda c: F.col(c) / n
    pairs = together.join(with_entity, "entity").join(with_term, "term")
    pmi = F.log2(share("n_both") / (share("n_term") * share("n_entity")))
    content = -F.log2(share("n_entity"))
    return pairs.withColumn("disclosure", F.when(content > 0, pmi / content).otherwise(0.0)) \
        .where(F.col("disclosure") >= GENERALISE).select("entity", "term", "disclosure")


def sanitise(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """For each row of ``df`` its id, the hash ``r`` of id and text, and ``spans``, the array of
    (start, kind, end) in order: direct identifiers and the terms that disclose them; kinds are
    numbers into ``KINDS``."""
    docs = df.select(F.col(id_col).alias("id"), F.xxhash64(F.col(id_col).cast("string"), text_of(text_col)).alias("r"),
                     text_of(text_col).alias("text"))
    based = stored(base_spans(docs).select("id", "r", "base"))
    mentions = based.where(F.size("base") > 0).dropDuplicates(["id", "r"]).select("id", "r", F.explode("base").alias("m")) \
        .withColumn("entity", F.xxhash64("m.kind", "m.value"))
    near = stored(_context_terms(mentions))
    kind = F.when(F.col("disclosure") >= REMOVE, KINDS.index("remove")).otherwise(KINDS.index("generalise"))
    terms = stored(disclosing_terms(near, mentions, docs, "text").groupBy("term").agg(F.min(kind).alias("kind")))
    more = _occurrences(docs, terms) \
        .groupBy("r", "id").agg(F.collect_list(F.struct("start", "kind", "end")).alias("more"))
    plain = F.transform("base", lambda x: F.struct(x["start"].alias("start"), x["kind"].alias("kind"), x["end"].alias("end")))
    met = based.alias("b").join(more.alias("t"), F.expr("b.r = t.r and b.id <=> t.id"), "left") \
        .select("b.id", "b.r", F.array_sort(F.concat(plain, F.coalesce("more", F.array().cast("array<struct<start:int,kind:int,end:int>>")))).alias("spans"))
    return met.select(F.col("id").alias(id_col), "r", "spans")


def count_of(kind: int, spans: str = "spans") -> Column:
    """Number of spans of a kind."""
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")


def listed(spans: Column) -> Column:
    """Spans as text: kind:start:end, joined by commas."""
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", names[s["kind"]], s["start"], s["end"])), ",")


def redacted(text: Column, spans: Column) -> Column:
    """The text with its spans replaced by their kind, or taken out if they are to be removed;
    a span inside an earlier one adds nothing."""
    names = F.array(*[F.lit("" if k == "remove" else f"[{k.upper()}]") for k in KINDS])
    begin = F.struct(F.lit("").alias("out"), F.lit(0).alias("at"))

    def step(a: Column, s: Column) -> Column:
        add = F.concat(F.substr(text, a["at"] + 1, s["start"] - a["at"]), names[s["kind"]])
        return F.when(s["start"] < a["at"], F.struct(a["out"].alias("out"), F.greatest(a["at"], s["end"]).alias("at"))) \
            .otherwise(F.struct(F.concat(a["out"], add).alias("out"), s["end"].alias("at")))

    done = F.aggregate(spans, begin, step)
    return F.concat(done["out"], F.substr(text, done["at"] + 1, F.length(text)))
