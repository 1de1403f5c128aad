"""URL filter: all glob rules are run at once by a bit-parallel automaton."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rivulet.llm.common import ascii_lower

#: Matrix cells (URLs times longest length) that a worker holds at once.
CELLS = 1 << 22
OTHER, END, BREAK = 0, 1, 2  # any other character; after the last one; between host and path


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host (after the first ``://`` up to / ? # or the end, A-Z lower-cased) and path (up to ? or #).

    A url that is null or has no ``://`` has an empty host and an empty path.
    """
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substr(url, at + 3)).otherwise("")
    host = ascii_lower(F.regexp_extract(rest, r"^([^/?#]*)", 1))
    return F.coalesce(host, F.lit("")), F.coalesce(
        F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1), F.lit(""))


def judge_urls(pages: DataFrame, rules: list[tuple[str, str]], id_column: str = "page_id",
               url_column: str = "url", otherwise: str = "allow") -> DataFrame:
    """Host, path, the longest fitting rule and its verdict for every url.

    A rule is ``host/path`` and a verdict. It fits its host and all subdomains where the path
    starts with the rule's path; ``*`` stands for any run of characters within the host or within
    the path, ``?`` for any one. Of several fitting rules the longest decides, of equally long
    ones the first in the list; without any the verdict is ``otherwise`` and the rule null.

    Every rule becomes a chain of bits in one row of 64-bit words, and one shift, one mask per
    character class and one mask of loops move all chains of all URLs one character ahead.
    Returns the id column, host, path, rule, verdict, one row per row of ``pages``; null urls are
    judged as empty, repeated rows are judged each, and other columns are ignored.
    """
    ranked = sorted(range(len(rules)), key=lambda i: (-len(rules[i][0]), i))
    automaton = Automaton([rules[i][0] for i in ranked])

    @F.pandas_udf("int")
    def first(host: pd.Series, path: pd.Series) -> pd.Series:
        return pd.Series(automaton.first_match(host.tolist(), path.tolist()), dtype="int32")

    host, path = host_and_path(F.col(url_column))
    judged = pages.select(F.col(id_column), host.alias("host"), path.alias("path")).select(
        id_column, "host", "path", first("host", "path").alias("_rule"))
    number = F.col("_rule")
    rule = F.array(*[F.lit(rules[i][0]) for i in ranked]) if rules else F.array().cast("array<string>")
    verdict = F.array(*[F.lit(rules[i][1]) for i in ranked]) if rules else rule
    return judged.select(
        id_column, "host", "path", F.when(number >= 0, F.get(rule, number)).alias("rule"),
        F.when(number >= 0, F.get(verdict, number)).otherwise(otherwise).alias("verdict"))


class Automaton:
    """Shift-And over all rules: bit i of a rule's chain is set when its first i symbols have matched."""

    def __init__(self, rules: list[str]) -> None:
        chains = [self._symbols(rule) for rule in rules]
        letters = sorted({s for chain in chains for s, _ in chain if isinstance(s, str) and len(s) == 1})
        self.letters = np.array([ord(c) for c in letters], dtype=np.uint32)
        classes = 3 + len(letters)
        bits = sum(len(chain) + 1 for chain in chains)
        step = np.zeros((classes, bits), dtype=bool)
        loop = np.zeros((classes, bits), dtype=bool)
        start = np.zeros(bits, dtype=bool)
        ends, at = [], 0
        for chain in chains:
            start[at] = True
            for i, (symbol, starred) in enumerate(chain):
                if starred:  # a star before this symbol: the state before it may stay within a part
                    loop[:, at + i] = True
                    loop[[END, BREAK], at + i] = False
                if symbol == "any":
                    step[:, at + i + 1] = True
                    step[[END, BREAK], at + i + 1] = False
                else:
                    own = BREAK if symbol == "break" else 3 + letters.index(symbol)
                    step[own, at + i + 1] = True
            ends.append(at + len(chain))
            loop[:, ends[-1]] = True  # a rule that has matched stays matched
            at += len(chain) + 1
        self.step, self.loop = self._packed(step), self._packed(loop)
        self.start = self._packed(start[None])[0]
        self.ends = np.array(ends, dtype=np.int64)

    @staticmethod
    def _symbols(rule: str) -> list[tuple[str, bool]]:
        """Symbols of a rule, each with whether a star stands before it; a star before all of them."""
        host, slash, path = rule.partition("/")
        out: list[tuple[str, bool]] = []
        starred = True
        for part in ("." + host, None, slash + path):
            if part is None:
                out.append(("break", starred))
                starred = False
                continue
            for c in part:
                if c == "*":
                    starred = True
                else:
                    out.append(("any" if c == "?" else c, starred))
                    starred = False
        return out

    @staticmethod
    def _packed(rows: np.ndarray) -> np.ndarray:
        words = max(1, -(-rows.shape[1] // 64))
        wide = np.zeros((rows.shape[0], words * 64), dtype=np.uint8)
        wide[:, :rows.shape[1]] = rows
        return np.packbits(wide, axis=1, bitorder="little").view(np.uint64)

    def classes_of(self, text: str) -> np.ndarray:
        points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
        if not len(self.letters):
            return np.zeros(len(points), dtype=np.int64)
        at = np.minimum(np.searchsorted(self.letters, points), len(self.letters) - 1)
        return np.where(self.letters[at] == points, at + 3, OTHER)

    def first_match(self, hosts: list[str], paths: list[str]) -> np.ndarray:
        """Number of the first rule that fits each host and path; -1 where none does."""
        out = np.full(len(hosts), -1, dtype=np.int32)
        sizes = np.array([len(h) + len(p) + 2 for h, p in zip(hosts, paths)], dtype=np.int64)
        order, at = np.argsort(sizes, kind="stable"), 0
        while at < len(order) and len(self.ends):
            # Neighbours in length share a matrix; a very long url is alone in its own.
            most = np.arange(1, len(order) - at + 1) * sizes[order[at:]]
            stop = at + max(1, int(np.searchsorted(most, CELLS, side="right")))
            rows = order[at:stop]
            out[rows] = self._run([(hosts[i], paths[i]) for i in rows], int(sizes[rows[-1]]))
            at = stop
        return out

    def _run(self, urls: list[tuple[str, str]], width: int) -> np.ndarray:
        text = np.full((len(urls), width), END, dtype=np.int64)
        for row, (host, path) in zip(text, urls):
            h = self.classes_of("." + host)
            row[:len(h)] = h
            row[len(h)] = BREAK
            p = self.classes_of(path)
            row[len(h) + 1:len(h) + 1 + len(p)] = p
        state = np.repeat(self.start[None], len(urls), axis=0)
        one, top = np.uint64(1), np.uint64(63)
        for column in range(width):
            symbol = text[:, column]
            moved = state << one
            moved[:, 1:] |= state[:, :-1] >> top
            state = (moved & self.step[symbol]) | (state & self.loop[symbol])
            if not state.any():
                break
        word, bit = self.ends >> 6, (self.ends & 63).astype(np.uint64)
        hit = (state[:, word] >> bit) & one == one
        return np.where(hit.any(axis=1), hit.argmax(axis=1), -1).astype(np.int32)
