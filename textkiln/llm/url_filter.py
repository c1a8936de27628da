"""URL filters as one bit-parallel automaton over all glob rules.

Every rule is a glob over the canonical form of a url. All globs are packed
side by side into 64-bit words: a bit is set when the url read so far can be
matched up to that place of its rule. One step per character, for all rules
and all urls of a batch at once, is a shift, an AND with the character's mask
and an OR with the places at which a star may go on (Shift-And with loops).

Canonical form: ``.`` + host + path, so that the first ``/``, if any, begins
the path. In a glob ``*`` stands for any run of characters but ``/``, ``**``
for any run, ``?`` for one character but ``/``.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .frames import map_texts, need_columns

# Fixed values: (verdict, host and path). A rule fits its host and all
# subdomains where the url's path begins with the rule's path.
SITE_RULES = (
    ("block", "net/"),
    ("allow", "example.net/en/"),
    ("block", "example.com/de/"),
    ("allow", "org/fr/"),
)

#: Rules for urls that no site rule fits: the first that matches counts.
GLOB_RULES = (
    ("block", "*spam*"),
    ("block", "*spam*/**"),
    ("block", "*casino*"),
    ("block", "*casino*/**"),
    ("block", "*/**/ads/**"),
    ("block", "*/ads/**"),
)
DEFAULT = "allow"


def split_url(url: str | None) -> tuple[str, str]:
    """Host (A-Z lower-cased) and path; both empty without ``://``."""
    if url is None:
        return "", ""
    _, found, rest = url.partition("://")
    if not found:
        return "", ""
    stop = min((i for i in map(rest.find, "/?#") if i >= 0), default=len(rest))
    host, tail = rest[:stop], rest[stop:]
    end = min((i for i in map(tail.find, "?#") if i >= 0), default=len(tail))
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host), tail[:end]


def canonical(host: str, path: str) -> str:
    return f".{host}{path}"


def site_glob(rule: str) -> str:
    """The glob of a site rule: any subdomain, then the path's beginning."""
    return f"*.{rule}**"


@dataclass
class Automaton:
    """Masks of all globs. Each glob has a bit for its beginning and one after
    each character; loops keep a bit set while a star goes on."""

    globs: tuple[str, ...]

    def __post_init__(self):
        places: list[tuple[str | None, str]] = []  # (character that leads here, loop: '', '*' or '**')
        self.first, self.last = [], []
        for glob in self.globs:
            self.first.append(len(places))
            places.append((None, ""))
            i = 0
            while i < len(glob):
                if glob[i] == "*":
                    star = "**" if glob[i : i + 2] == "**" else "*"
                    if len(star) > len(places[-1][1]):
                        places[-1] = (places[-1][0], star)
                    i += len(star)
                else:
                    places.append((glob[i], ""))
                    i += 1
            self.last.append(len(places) - 1)
        self.words = -(-len(places) // 64)
        letters = sorted({c for c, _ in places if c is not None and c != "?"} | {"/"})
        self.letter = {ord(c): i + 1 for i, c in enumerate(letters)}  # 0: all others
        self.slash = self.letter[ord("/")]
        self.step = np.zeros((len(letters) + 1, self.words), np.uint64)
        self.loop = np.zeros_like(self.step)
        self.start = np.zeros(self.words, np.uint64)
        for p, (c, star) in enumerate(places):
            word, bit = p // 64, np.uint64(1 << (p % 64))
            for k in range(len(letters) + 1):
                if c == "?" and k != self.slash or c is not None and c != "?" and k == self.letter[ord(c)]:
                    self.step[k, word] |= bit
                if star == "**" or star == "*" and k != self.slash:
                    self.loop[k, word] |= bit
        for p in self.first:
            self.start[p // 64] |= np.uint64(1 << (p % 64))

    def codes(self, text: str) -> np.ndarray:
        points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
        out = np.zeros(len(points), np.int32)
        for point, code in self.letter.items():
            out[points == point] = code
        return out

    def matches(self, texts: list[str], cells: int = 1 << 20) -> np.ndarray:
        """``len(texts) x len(globs)``: which globs match which whole texts. As
        many texts run at once as keep the state within ``cells`` words."""
        hits = np.zeros((len(texts), len(self.globs)), bool)
        step = max(1, cells // self.words)
        for start in range(0, len(texts), step):
            hits[start : start + step] = self._run(texts[start : start + step])
        return hits

    def _run(self, texts: list[str]) -> np.ndarray:
        n = len(texts)
        hits = np.zeros((n, len(self.globs)), bool)
        coded = [self.codes(t) for t in texts]
        sizes = np.fromiter(map(len, coded), np.int64, n)
        order = np.argsort(-sizes, kind="stable")
        flat = np.concatenate([coded[i] for i in order]) if sizes.sum() else np.zeros(0, np.int32)
        begin = np.concatenate([[0], np.cumsum(sizes[order])[:-1]])
        live = np.tile(self.start, (n, 1))
        one, top = np.uint64(1), np.uint64(63)
        for at in range(int(sizes.max())):
            m = int(np.searchsorted(-sizes[order], -at, side="left"))  # texts longer than at
            code = flat[begin[:m] + at]
            now = live[:m]
            moved = now << one
            if self.words > 1:
                moved[:, 1:] |= now[:, :-1] >> top
            live[:m] = (moved & self.step[code]) | (now & self.loop[code])
        for g, p in enumerate(self.last):
            hits[order, g] = (live[:, p // 64] >> np.uint64(p % 64)) & one == one
        return hits


def judge(urls: list[str | None], sites=SITE_RULES, globs=GLOB_RULES, automaton: Automaton | None = None) -> list[tuple[str, str, str | None, str]]:
    """(host, path, rule, verdict) of each url."""
    automaton = automaton or build(sites, globs)
    parts = [split_url(u) for u in urls]
    hits = automaton.matches([canonical(*p) for p in parts])
    # the longest site rule that fits; of equal ones the first
    ranked = sorted(range(len(sites)), key=lambda i: -len(sites[i][1]))
    out = []
    for (host, path), row in zip(parts, hits):
        site = next((i for i in ranked if row[i]), None)
        if site is not None:
            out.append((host, path, sites[site][1], sites[site][0]))
            continue
        other = next((globs[i][0] for i in range(len(globs)) if row[len(sites) + i]), DEFAULT)
        out.append((host, path, None, other))
    return out


def build(sites=SITE_RULES, globs=GLOB_RULES) -> Automaton:
    return Automaton(tuple([site_glob(r) for _, r in sites] + [g for _, g in globs]))


def filter_urls(pages: DataFrame, sites=SITE_RULES, globs=GLOB_RULES) -> DataFrame:
    """``(page_id, host, path, rule, verdict)`` for every row of ``pages``.

    A null url, and one without ``://``, has an empty host and path; no site
    rule fits it. Each row is judged by itself: repeated rows get equal
    verdicts. Urls of any length are read whole. Of site rules of one length
    the first given wins, of globs the first that matches. A null ``page_id``
    stays null. An empty table gives no rows; other columns are ignored and not
    read, whatever their names.
    """
    automaton = build(sites, globs)

    def fn(batch: pa.RecordBatch) -> pa.RecordBatch:
        cols = list(zip(*judge(batch.column(1).to_pylist(), sites, globs, automaton))) or [()] * 4
        return pa.RecordBatch.from_arrays([batch.column(0), *[pa.array(c, pa.string()) for c in cols]], names=["page_id", "host", "path", "rule", "verdict"])

    return map_texts(need_columns(pages, page_id="long", url="string"), "url", fn, "page_id long, host string, path string, rule string, verdict string")


def _like(glob: str) -> str:
    """A glob as a regular expression, for the SQL that states the result."""
    out, i = "", 0
    while i < len(glob):
        if glob.startswith("**", i):
            out, i = out + "(?s:.*)", i + 2
        elif glob[i] == "*":
            out, i = out + "[^/]*", i + 1
        elif glob[i] == "?":
            out, i = out + "[^/]", i + 1
        else:
            out, i = out + ("\\" + glob[i] if glob[i] in ".+()[]{}^$|\\" else glob[i]), i + 1
    return f"^{out}$"


def oracle_sql(sites=SITE_RULES, globs=GLOB_RULES) -> str:
    """DuckDB SQL for the rows of ``filter_urls`` over ``pages``."""
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    ranked = sorted(sites, key=lambda r: -len(r[1]))
    fits = []
    for _, rule in ranked:
        host, slash, path = rule.partition("/")
        fits.append(f"((host = '{host}' OR ends_with(host, '.{host}')) AND starts_with(path, '{slash}{path}'))")
    rule = " ".join(f"WHEN {f} THEN '{r}'" for f, (_, r) in zip(fits, ranked))
    verdict = " ".join(f"WHEN {f} THEN '{v}'" for f, (v, _) in zip(fits, ranked))
    other = " ".join(f"WHEN regexp_matches('.' || host || path, '{_like(g)}') THEN '{v}'" for v, g in globs)
    return f"""
WITH parts AS (
  SELECT page_id,
    CASE WHEN contains(url, '://') THEN regexp_extract(substr(url, position('://' IN url) + 3), '^[^/?#]*') ELSE '' END AS raw_host,
    CASE WHEN contains(url, '://') THEN regexp_extract(substr(url, position('://' IN url) + 3), '^[^/?#]*([^?#]*)', 1) ELSE '' END AS raw_path
  FROM pages),
named AS (SELECT page_id, translate(coalesce(raw_host, ''), '{upper}', '{lower}') AS host, coalesce(raw_path, '') AS path FROM parts)
SELECT page_id, host, path, CASE {rule} END AS rule, CASE {verdict} {other} ELSE '{DEFAULT}' END AS verdict
FROM named"""
