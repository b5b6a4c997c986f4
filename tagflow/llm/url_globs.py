"""URL filters: a bit-parallel wildcard automaton over canonical URLs.

Every glob rule is packed into one long bit mask (Shift-And): a bit for each character of
each rule, over as many 64-bit words as needed. All URLs of a batch step through their
characters together, all rules at once: states move one bit up where the character
allows, and a `*` keeps its state while its class of characters lasts.

A canonical URL is "." + host + NUL + path. A host glob's `*` stands for characters of the
host only, so a name in the path is never taken for a host.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SEPARATOR = "\0"


@dataclass(frozen=True)
class Rule:
    """host and path as globs with `*`. A plain rule's host also fits its subdomains, and its path what begins with it."""

    verdict: str
    host: str
    path: str = "/"
    plain: bool = True  # False: host and path are whole globs

    @property
    def name(self) -> str:
        return self.host + self.path

    def glob(self) -> list[tuple[str, str]]:
        """Bytes as characters, and `*` with the class it stands for."""
        host, path = (f"*.{self.host}", f"{self.path}*") if self.plain else (self.host, self.path)
        host = host if self.plain else f".{host}" if not host.startswith("*") else host
        parts = [[("*", kind) if b == 42 else (chr(b), "") for b in glob.encode()] for glob, kind in ((host, "host"), (path, "path"))]
        return [*parts[0], (SEPARATOR, ""), *parts[1]]


#: The given rules, fixed by the contract of the query.
CONTRACT_RULES = (
    Rule("allow", "org", "/"), Rule("block", "example.org", "/es/"), Rule("block", "example.org", "/en/1"), Rule("allow", "com", "/fr/"), Rule("block", "com", "/de/"))
#: What is blocked where no given rule fits: names of link farms, and tracker and login pages.
DEFAULT_GLOBS = (
    Rule("block", "*spam*", "*", False), Rule("block", "*casino*", "*", False), Rule("block", "*adult*", "*", False),
    Rule("block", "*", "*/login*", False), Rule("block", "*", "*/track/*", False))


class Automaton:
    """Masks of all rules over the bytes of canonical URLs."""

    def __init__(self, rules: tuple[Rule, ...]) -> None:
        size = sum(len([c for c in r.glob() if c[0] != "*"]) + 1 for r in rules)
        self.words = max(1, -(-size // 64))
        self.chars = np.zeros((256, self.words), np.uint64)
        self.stay = np.zeros((256, self.words), np.uint64)
        self.first = np.zeros(self.words, np.uint64)
        self.last: list[tuple[int, np.uint64]] = []
        # a rule's bit 0 says that nothing is matched yet; bit i that i characters are
        at = 0
        for r in rules:
            self._set(self.first, at)
            for c, kind in r.glob():
                if c == "*":
                    for b in range(256):
                        if kind == "path" or b != 0:
                            self._set(self.stay[b], at)
                else:
                    at += 1
                    self._set(self.chars[ord(c)], at)
            self.last.append((at // 64, np.uint64(1) << np.uint64(at % 64)))
            at += 1

    @staticmethod
    def _set(row: np.ndarray, bit: int) -> None:
        row[bit // 64] |= np.uint64(1) << np.uint64(bit % 64)

    def fits(self, urls: list[bytes]) -> np.ndarray:
        """(urls, rules): whether the whole URL fits the rule."""
        out = np.zeros((len(urls), len(self.last)), bool)
        lens = np.array([len(u) for u in urls], np.int64)
        order = np.argsort(-lens, kind="stable")  # the longest first: those still running are a prefix
        data = np.frombuffer(b"".join(urls), np.uint8)
        begin = (np.cumsum(lens) - lens)[order]
        state = np.tile(self.first, (len(urls), 1))
        running = np.searchsorted(-lens[order], -np.arange(1, (lens.max() if len(lens) else 0) + 1), "right")
        for k, n in enumerate(running):
            c = data[begin[:n] + k]
            now = state[:n]
            up = now << np.uint64(1)
            up[:, 1:] |= now[:, :-1] >> np.uint64(63)
            state[:n] = (up & self.chars[c]) | (now & self.stay[c])
        for j, (word, bit) in enumerate(self.last):
            out[order, j] = (state[:, word] & bit) != 0
        return out


def url_parts(url: Column) -> tuple[Column, Column]:
    """(host, path): host after the first :// up to / ? # or the end, A-Z lower-cased; path then up to ? or #. Null or no ://: empty."""
    begin = F.instr(url, "://")
    rest = F.when(begin > 0, F.substring(url, begin + 3, F.length(url))).otherwise(F.lit(""))
    host = F.regexp_extract(rest, r"^[^/?#]*", 0)
    path = F.regexp_extract(F.substring(rest, F.length(host) + 1, F.length(rest)), r"^[^?#]*", 0)
    letters = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return F.coalesce(F.translate(host, letters, letters.lower()), F.lit("")), F.coalesce(path, F.lit(""))


def filter_urls(pages: DataFrame, rules: tuple[Rule, ...] = CONTRACT_RULES, globs: tuple[Rule, ...] = DEFAULT_GLOBS) -> DataFrame:
    """One row per row of pages(page_id, url): page_id, host, path, rule, verdict, glob.

    rule: of the rules that fit, the longest (of equals the first); else null. verdict: the
    rule's; else "block" if one of globs fits, else "allow". glob: the first of globs that fits, if it
    decided. Null, empty and malformed URLs have an empty host and path, so no plain rule
    fits. Rules are parameters of a bounded number, compared with URLs byte by byte in UTF-8.
    Repeated rows are judged alike, other columns are ignored.
    """
    every = (*rules, *globs)
    # in the order in which they decide; the last stands for none
    rank = [*sorted(range(len(rules)), key=lambda i: (-len(rules[i].name), i)), *range(len(rules), len(every))]
    name = pa.array([rules[i].name if i < len(rules) else None for i in rank] + [None], pa.string())
    verdict = pa.array([every[i].verdict for i in rank] + ["allow"])
    used = pa.array([None if i < len(rules) else f"{every[i].host} {every[i].path}" for i in rank] + [None], pa.string())

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = Automaton(every)
        for batch in batches:
            hosts, paths = batch.column("host").to_pylist(), batch.column("path").to_pylist()
            # a NUL in a URL is not the separator
            fits = automaton.fits([f".{h.replace(SEPARATOR, ' ')}{SEPARATOR}{p.replace(SEPARATOR, ' ')}".encode() for h, p in zip(hosts, paths, strict=True)])
            ordered = np.ones((len(fits), len(every) + 1), bool)
            ordered[:, :-1] = fits[:, rank]
            first = pa.array(ordered.argmax(1))
            yield pa.RecordBatch.from_arrays(
                [batch.column("page_id"), batch.column("host"), batch.column("path"), name.take(first), verdict.take(first), used.take(first)],
                ["page_id", "host", "path", "rule", "verdict", "glob"])

    host, path = url_parts(F.col("url"))
    return pages.select(F.col("page_id").cast("long").alias("page_id"), host.alias("host"), path.alias("path")).mapInArrow(
        judge, "page_id long, host string, path string, rule string, verdict string, glob string")
