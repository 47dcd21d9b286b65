"""URL filters: many glob rules simulated at once by a bit-parallel automaton.

A rule is a glob over the canonical URL ``.host/path``: ``?`` is any one byte,
``*`` any run of bytes without ``/``, ``**`` any run of bytes; all else stands for
itself.  Every rule takes one bit for its start and one for each byte it
consumes, packed into 64-bit words (multiword Shift-And).  Reading byte c turns
the states S into ``((S << 1) & MASK[c]) | (S & LOOP[c])``: the first part steps all
rules at once, the second lets stars stay where they are.  numpy runs this over
all URLs of a batch together, byte by byte, dropping URLs as they end.

Defined results: a null URL, or one without ``://``, has an empty host and path
and matches only rules for that.  A host-and-path rule fits the host itself and
its subdomains; of several fitting rules the longest wins, then the
alphabetically first.  Without a fitting rule the glob rules decide; without a
fitting glob the URL is allowed.  Repeated rows get equal results.  Input
columns that carry an output's name are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Host-and-path rules (verdict, rule).
SITE_RULES = (("allow", "com/"), ("block", "example.com/en/"), ("allow", "www.example.com/en/"),
              ("block", "net/es/"), ("block", "net/fr/"))
#: Words that block a host, and endings that block a path, where no site rule fits.
BAD_HOST_WORDS = ("spam", "pills", "casino", "porn")
BAD_ENDINGS = (".exe", ".zip", ".iso")

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def default_globs() -> list[tuple[str, str]]:
    """The glob rules (verdict, glob) built from the fixed words above."""
    hosts = [("block", f"*{w}*{tail}") for w in BAD_HOST_WORDS for tail in ("", "/**")]
    return hosts + [("block", f"**{e}") for e in BAD_ENDINGS]


def site_glob(rule: str) -> str:
    """A host-and-path rule as a glob: the host or a subdomain, then the path's start."""
    return f"*.{_escaped(rule)}**"


def _escaped(text: str) -> str:
    return "".join(f"[{c}]" if c in "*?[" else c for c in text)


def parse_glob(glob: str) -> tuple[list[int], dict[int, str]]:
    """Bytes consumed in order (-1: any) and, by number of bytes consumed, the star that may follow."""
    data, items, stars, i = glob.encode(), [], {}, 0
    while i < len(data):
        c = chr(data[i])
        if c == "*":
            double = data[i:i + 2] == b"**"
            if double or len(items) not in stars:
                stars[len(items)] = "**" if double else "*"
            i += 2 if double else 1
        elif c == "[" and data[i + 2:i + 3] == b"]":
            items.append(data[i + 1])
            i += 3
        else:
            items.append(-1 if c == "?" else data[i])
            i += 1
    return items, stars


class GlobSet:
    """Globs packed into Shift-And masks; ``first_match`` gives the first that fits each URL."""

    def __init__(self, globs: list[str]):
        parsed = [parse_glob(g) for g in globs]
        starts = np.cumsum([0] + [len(items) + 1 for items, _ in parsed])
        words = max(1, -(-int(starts[-1]) // 64))
        self.mask = np.zeros((256, words), np.uint64)
        self.loop = np.zeros((256, words), np.uint64)
        self.start = np.zeros(words, np.uint64)
        self.final = []
        slash = ord("/")
        for (items, stars), at in zip(parsed, starts, strict=False):
            def put(table, rows, bit):
                table[rows, bit // 64] |= np.uint64(1) << np.uint64(bit % 64)
            self.start[at // 64] |= np.uint64(1) << np.uint64(at % 64)
            for k, byte in enumerate(items):
                put(self.mask, slice(None) if byte < 0 else byte, at + k + 1)
            for k, star in stars.items():
                put(self.loop, slice(None) if star == "**" else [b for b in range(256) if b != slash], at + k)
            self.final.append(int(at) + len(items))

    def first_match(self, urls: list[bytes]) -> np.ndarray:
        """Number of the first glob that fits each URL whole; -1 for none."""
        length = np.fromiter(map(len, urls), np.int64, len(urls))
        order = np.argsort(-length, kind="stable")
        ordered = [urls[i] for i in order]
        data = np.frombuffer(b"".join(ordered), np.uint8)
        size = length[order]
        begin = np.cumsum(size) - size
        state = np.tile(self.start, (len(urls), 1))
        alive = np.searchsorted(-size, -np.arange(int(size[0]) if len(size) else 0), side="left")
        for t, n in enumerate(alive):
            byte = data[begin[:n] + t]
            now = state[:n]
            step = now << np.uint64(1)
            step[:, 1:] |= now[:, :-1] >> np.uint64(63)
            state[:n] = (step & self.mask[byte]) | (now & self.loop[byte])
        found = np.full(len(urls), -1, np.int64)
        for k, bit in reversed(list(enumerate(self.final))):
            found[(state[:, bit // 64] >> np.uint64(bit % 64)) & np.uint64(1) > 0] = k
        out = np.empty_like(found)
        out[order] = found
        return out


def host_of(url: Column) -> Column:
    """Between the first ``://`` and ``/``, ``?``, ``#`` or the end; A-Z in lower case; else empty."""
    return F.coalesce(F.translate(F.regexp_extract(_rest(url), r"^[^/?#]*", 0), _UPPER, _LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    """What follows the host, up to ``?``, ``#`` or the end; else empty."""
    return F.coalesce(F.regexp_extract(_rest(url), r"^[^/?#]*([^?#]*)", 1), F.lit(""))


def _rest(url: Column) -> Column:
    at = F.instr(url, "://")
    return F.when(at > 0, F.substr(url, at + 3))


def judge(df: DataFrame, url_col: str = "url", site_rules=SITE_RULES, globs=None) -> DataFrame:
    """``df`` with ``host``, ``path``, ``rule`` (the site rule that won, or null),
    ``glob`` (the glob that decided, or null) and ``verdict``."""
    globs = default_globs() if globs is None else list(globs)
    ranked = sorted(site_rules, key=lambda r: (-len(r[1]), r[1]))
    patterns = GlobSet([site_glob(rule) for _, rule in ranked] + [g for _, g in globs])
    rules = [r for _, r in ranked] + [None] * len(globs)
    names = [None] * len(ranked) + [g for _, g in globs]
    verdicts = [v for v, _ in ranked] + [v for v, _ in globs]

    @F.arrow_udf("struct<rule:string,glob:string,verdict:string>")
    def run(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for host, path in batches:
            urls = [f".{h}{p}".encode() for h, p in zip(host.to_pylist(), path.to_pylist(), strict=True)]
            found = patterns.first_match(urls).tolist()
            pick = lambda values, other: pa.array([values[k] if k >= 0 else other for k in found], pa.string())
            yield pa.StructArray.from_arrays([pick(rules, None), pick(names, None), pick(verdicts, "allow")],
                                             names=["rule", "glob", "verdict"])

    url = F.col(url_col).cast("string")
    got = df.withColumns({"__host": host_of(url), "__path": path_of(url)})
    got = got.withColumn("__url", run(F.col("__host"), F.col("__path")))
    return got.withColumns({"host": F.col("__host"), "path": F.col("__path"), "rule": F.col("__url.rule"),
                            "glob": F.col("__url.glob"), "verdict": F.col("__url.verdict")}) \
        .drop("__host", "__path", "__url")


def judge_sql(table: str = "pages") -> str:
    """The verdict of :func:`judge` with the default rules, as DuckDB SQL."""
    cases = []
    for verdict, rule in sorted(SITE_RULES, key=lambda r: (-len(r[1]), r[1])):
        host, _, path = rule.partition("/")
        cases.append((f"('.' || host) LIKE '%.{host}' AND starts_with(path, '/{path}')", rule, verdict))
    bad = [f"host LIKE '%{w}%'" for w in BAD_HOST_WORDS] + [f"('.' || host || path) LIKE '%{e}'" for e in BAD_ENDINGS]
    rule = " ".join(f"WHEN {c} THEN '{r}'" for c, r, _ in cases)
    verdict = " ".join(f"WHEN {c} THEN '{v}'" for c, _, v in cases)
    return f"""
    WITH r AS (SELECT page_id, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) END AS rest
               FROM {table}),
    p AS (SELECT page_id, coalesce(translate(regexp_extract(rest, '^[^/?#]*'), '{_UPPER}', '{_LOWER}'), '') AS host,
                 coalesce(regexp_extract(rest, '^[^/?#]*([^?#]*)', 1), '') AS path FROM r)
    SELECT page_id, host, path, CASE {rule} END AS rule,
           CASE {verdict} WHEN {' OR '.join(bad)} THEN 'block' ELSE 'allow' END AS verdict FROM p"""
