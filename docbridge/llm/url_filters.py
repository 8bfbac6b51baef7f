"""URL filters as a bit-parallel wildcard automaton.

All glob rules are packed one after another into the bits of a few machine words.  A
bit stands for a place in a rule, and one step of the automaton - shift, or, and -
moves every rule by one character of the URL; a wildcard lets the bit before it stay.
``**`` stands for any run of bytes, ``*`` for any run without a slash.  The
steps are taken for a whole batch of URLs at once, over the words of the masks.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import common

ONE = np.uint64(1)
#: URLs advance together in groups of at most so many cells (URLs times longest length) and words of state.
CELLS, STATE = 1 << 22, 1 << 21


@dataclass(frozen=True)
class Rule:
    """``pattern`` is a glob over a whole canonical URL (a dot, the host, the path)."""

    pattern: str
    verdict: str
    name: str
    priority: int


class Globs:
    """Shift-And over all patterns at once."""

    def __init__(self, patterns: list[str]):
        chars: list[int] = []  # byte of each bit; -1 is the start of a pattern
        stay: list[int] = []  # 0: no wildcard follows, 1: one that a slash ends, 2: any
        self.last: list[int] = []
        starts: list[int] = []
        for p in patterns:
            starts.append(len(chars))
            chars.append(-1)
            stay.append(0)
            for c in p.encode():
                if c == 42:
                    stay[-1] = min(2, stay[-1] + 1)
                else:
                    chars.append(c)
                    stay.append(0)
            self.last.append(len(chars) - 1)
        self.words = max(1, -(-len(chars) // 64))
        self.step = np.zeros((256, self.words), np.uint64)
        self.stay = np.zeros((256, self.words), np.uint64)  # bits that a byte lets stay
        self.start = np.zeros(self.words, np.uint64)
        for i, c in enumerate(chars):
            bit = ONE << np.uint64(i & 63)
            if c >= 0:
                self.step[c, i >> 6] |= bit
            if stay[i]:
                self.stay[:, i >> 6] |= bit
            if stay[i] == 1:
                self.stay[47, i >> 6] &= ~bit
        for i in starts:
            self.start[i >> 6] |= ONE << np.uint64(i & 63)

    def match(self, raw: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Rows x patterns: which patterns match the whole of which string."""
        n = len(offsets) - 1
        out = np.zeros((n, len(self.last)), bool)
        sizes = np.diff(offsets)
        order = np.argsort(sizes, kind="stable")
        lo = 0
        while lo < n:
            hi = n  # as many of the next shortest strings as fit
            while hi > lo + 1 and (hi - lo) * int(sizes[order[hi - 1]]) > CELLS:
                hi = lo + max(1, (hi - lo) // 2)
            hi = min(hi, lo + max(1, STATE // self.words))
            rows = order[lo:hi]
            out[rows] = self._run(raw, offsets[rows], sizes[rows])
            lo = hi
        return out

    def _run(self, raw: np.ndarray, at: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        state = np.tile(self.start, (len(at), 1))
        for j in range(int(sizes[-1]) if len(sizes) else 0):
            live = int(np.searchsorted(sizes, j, "right"))  # sizes ascend: those longer than j
            s = state[live:]
            shifted = s << ONE
            shifted[:, 1:] |= s[:, :-1] >> np.uint64(63)
            c = raw[at[live:] + j]
            state[live:] = (shifted & self.step[c]) | (s & self.stay[c])
        cols = [(state[:, i >> 6] >> np.uint64(i & 63)) & ONE for i in self.last]
        return np.stack(cols, 1).astype(bool)


def host_path(url: Column) -> tuple[Column, Column]:
    """Host in lower case (A-Z) and path as the rules see them; both empty without ``://``."""
    rest = F.when(F.instr(url, "://") > 0, F.expr("substr(url, instr(url, '://') + 3)")).otherwise(F.lit(""))
    lower = F.translate(F.regexp_extract(rest, r"^([^/?#]*)", 1), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return lower, F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def site_rule(host: str, path: str, verdict: str) -> list[Rule]:
    """A rule for a host, its subdomains and paths that start with ``path``.

    Canonical URLs start with a dot, which covers both the host itself and its
    subdomains.  Longer rules win.
    """
    return [Rule(f"*.{host}{path}**", verdict, f"{host}{path}", len(host) + len(path))]


#: The site rules.
SITE_RULES = (
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
)
#: The method's own globs for what no site rule decides; the rest is allowed.
GENERAL = (
    Rule("**spam**", "block", "**spam**", 0),
    Rule("**casino**", "block", "**casino**", 0),
    Rule("**.porn**", "block", "**.porn**", 0),
    Rule("**phish**", "block", "**phish**", 0),
)


def site_rules(rules: tuple = SITE_RULES) -> list[Rule]:
    return [r for host, path, verdict in rules for r in site_rule(host, path, verdict)]


def judge(pages: DataFrame, rules: list[Rule] | None = None, general: tuple[Rule, ...] = GENERAL, default: str = "allow") -> DataFrame:
    """page_id, host, path, rule, verdict of every url; no shuffle.

    The longest site rule that fits decides (among equals the first listed); where none
    fits, ``rule`` is null and the general globs decide: the first that matches, else
    ``default``.  A null url, or one without ``://``, has an empty host and path.  Urls
    are whole, however long; repeated rows each give a row, an empty table none; other
    columns are not looked at, whatever their names.
    """
    rules = site_rules() if rules is None else rules
    automaton = Globs([r.pattern for r in rules] + [r.pattern for r in general])
    best = sorted(range(len(rules)), key=lambda i: -rules[i].priority)
    u = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"))
    host, path = host_path(F.coalesce("url", F.lit("")))
    canonical = u.select("page_id", host.alias("host"), path.alias("path")).withColumn("canonical", F.concat(F.lit("."), "host", "path"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, raw, offs in common.text_steps(batches, "canonical"):
            hit = automaton.match(raw, offs)
            rule: list[str | None] = [None] * rows.num_rows
            verdict = [default] * rows.num_rows
            for i in range(len(general) - 1, -1, -1):
                for k in np.flatnonzero(hit[:, len(rules) + i]):
                    verdict[k] = general[i].verdict
            for i in reversed(best):
                for k in np.flatnonzero(hit[:, i]):
                    rule[k], verdict[k] = rules[i].name, rules[i].verdict
            yield pa.RecordBatch.from_arrays([*rows.columns[:3], common.strings(rule), common.strings(verdict)], ["page_id", "host", "path", "rule", "verdict"])

    return canonical.mapInArrow(run, "page_id long, host string, path string, rule string, verdict string")
