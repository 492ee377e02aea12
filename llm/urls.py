"""URL rules as globs in one bit-parallel automaton.

All globs share one row of bits, one for each literal and one for each start. Reading a byte moves every
active bit one place up where the literal there is that byte (Shift-And) and keeps bits that stand
before a star. The row is several 64-bit words; a batch of URLs is simulated together, byte by byte.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from llm.shared import lower_ascii

_ONE = np.uint64(1)


@dataclass(frozen=True)
class UrlRule:
    """verdict for a host glob and a path glob; stars in the host stay within it."""

    name: str
    verdict: str
    hosts: tuple[str, ...]
    path: str = "*"

    @classmethod
    def of(cls, verdict: str, rule: str) -> UrlRule:
        """"host/path": the host and its subdomains, paths that start with the rule's."""
        host, slash, path = rule.partition("/")
        return cls(rule, verdict, (host, f"*.{host}"), f"{slash}{path}*")


LISTED = (
    UrlRule.of("allow", "org/"),
    UrlRule.of("block", "example.org/es/"),
    UrlRule.of("block", "example.org/en/1"),
    UrlRule.of("allow", "com/fr/"),
    UrlRule.of("block", "com/de/"),
)
GENERAL = tuple(UrlRule(word, "block", (f"*{word}*",)) for word in ("casino", "adult", "free-bets", "spam"))


class GlobAutomaton:
    def __init__(self, globs: Sequence[tuple[str, str]]):
        """globs: host and path glob of each pattern."""
        steps, loops, self.first, self.last = [], [], [], []
        for host, path in globs:
            self.first.append(len(steps))
            steps.append(None)
            loops.append(None)
            for part, inside in ((host, True), ("\0", None), (path, False)):
                for byte in part.encode():
                    if byte == ord("*") and inside is not None:
                        loops[-1] = "host" if inside and loops[-1] is None else "any" if not inside else loops[-1]
                    else:
                        steps.append(byte)
                        loops.append(None)
            self.last.append(len(steps) - 1)
        self.words = len(steps) // 64 + 1
        self.step, self.loop = (np.zeros((256, self.words), np.uint64) for _ in range(2))
        self.start = np.zeros(self.words, np.uint64)
        for bit, (byte, loop) in enumerate(zip(steps, loops)):
            word, mask = bit // 64, _ONE << np.uint64(bit % 64)
            if byte is None:
                self.start[word] |= mask
            else:
                self.step[byte, word] |= mask
            if loop is not None:
                self.loop[:, word] |= mask
                if loop == "host":
                    self.loop[0, word] &= ~mask

    def matches(self, texts: Sequence[bytes]) -> np.ndarray:
        """A row of booleans, one for each pattern, for each text."""
        lengths = np.array([len(t) for t in texts], np.int64)
        order = np.argsort(-lengths, kind="stable")
        data = np.frombuffer(b"".join(texts), np.uint8)
        begin = (np.cumsum(lengths) - lengths)[order]
        lengths = lengths[order]
        state = np.tile(self.start, (len(texts), 1))
        for place in range(int(lengths[0]) if len(lengths) else 0):
            live = int(np.searchsorted(-lengths, -place, "left"))
            byte = data[begin[:live] + place]
            now = state[:live]
            moved = now << _ONE
            moved[:, 1:] |= now[:, :-1] >> np.uint64(63)
            state[:live] = (moved & self.step[byte]) | (now & self.loop[byte])
        out = np.empty((len(texts), len(self.last)), bool)
        for i, bit in enumerate(self.last):
            out[order, i] = (state[:, bit // 64] >> np.uint64(bit % 64)) & _ONE == _ONE
        return out


def url_parts(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path of a URL; both empty for null or without "://"."""
    pattern = r"(?s)^.*?://([^/?#]*)([^?#]*)"
    return tuple(F.coalesce(x, F.lit("")) for x in (lower_ascii(F.regexp_extract(url, pattern, 1)), F.regexp_extract(url, pattern, 2)))


def _longest(rules: Sequence[UrlRule]):
    """Position in rules of the longest-named rule that fits, or -1."""
    rank = sorted(range(len(rules)), key=lambda i: (-len(rules[i].name), i))
    globs = [(host, rules[i].path) for i in rank for host in rules[i].hosts]
    owner = [i for i in rank for _ in rules[i].hosts]

    def longest(urls: pd.Series) -> pd.Series:
        automaton = GlobAutomaton(globs)
        hit = automaton.matches([u.encode() for u in urls])
        return pd.Series(np.where(hit.any(1), np.array(owner)[hit.argmax(1)], -1), dtype="int32")

    return F.pandas_udf(longest, "int")


def judged(pages: DataFrame, listed: Sequence[UrlRule] = LISTED, general: Sequence[UrlRule] = GENERAL, url: str = "url") -> DataFrame:
    """pages with host, path, rule (the longest listed rule that fits, else null) and verdict.

    Without a listed rule the longest general rule that fits decides, without one the URL is allowed.
    Null URLs have an empty host and path, which fits no rule given here. Rows are judged one by one.
    """
    host, path = url_parts(F.col(f"`{url}`"))
    out = pages.withColumns({"host": host, "path": path})
    canonical = F.concat(F.replace("host", F.lit("\0"), F.lit("")), F.lit("\0"), "path")
    out = out.withColumns({"_listed": _longest(listed)(canonical), "_general": _longest(general)(canonical)})
    names, verdicts = F.array(*[F.lit(r.name) for r in listed]), F.array(*[F.lit(r.verdict) for r in listed])
    other = F.array(*[F.lit(r.verdict) for r in general])
    verdict = F.coalesce(F.get(verdicts, F.col("_listed")), F.get(other, F.col("_general")), F.lit("allow"))
    return out.withColumns({"rule": F.get(names, F.col("_listed")), "verdict": verdict}).drop("_listed", "_general")
