"""Brute-force versions of the operators, over plain lists of (id, text)."""

from __future__ import annotations

import collections
import re

import duckdb
import numpy as np

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def rows(sf: str, sql: str) -> list[tuple]:
    con = duckdb.connect()
    for t in ("documents", "labels", "embeddings", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf}/{t}.parquet')")
    return con.execute(sql).fetchall()


def shingles(text: str | None) -> set[tuple[str, ...]]:
    words = WORD.findall((text or "").translate(LOWER))
    if len(words) < 5:
        return {tuple(words)} if words else set()
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)}


class Union:
    def __init__(self, items):
        self.up = {i: i for i in items}

    def find(self, x):
        while self.up[x] != x:
            self.up[x] = self.up[self.up[x]]
            x = self.up[x]
        return x

    def join(self, a, b):
        a, b = self.find(a), self.find(b)
        if a != b:
            self.up[max(a, b)] = min(a, b)


def jaccard(docs: list[tuple[int, str | None]]) -> dict[int, tuple[int, int]]:
    """id -> (set size, least id of its component), all pairs compared."""
    sets = [(i, shingles(t)) for i, t in docs]
    where = collections.defaultdict(list)
    for k, (_, s) in enumerate(sets):
        for x in s:
            where[x].append(k)
    comps = Union([i for i, _ in sets])
    for k, (i, s) in enumerate(sets):
        met = collections.Counter(j for x in s for j in where[x] if j > k)
        for j, n in met.items():
            if 100 * n >= 75 * (len(s) + len(sets[j][1]) - n):
                comps.join(i, sets[j][0])
    return {i: (len(s), comps.find(i)) for i, s in sets}


def cosine(vectors: list[tuple[int, list[float]]], least: float) -> dict[int, tuple[int, int]]:
    """id -> (links, least id of its component), all pairs compared."""
    ids = [i for i, _ in vectors]
    unit = np.array([v for _, v in vectors], float)
    unit /= np.linalg.norm(unit, axis=1)[:, None]
    close = unit @ unit.T >= least
    np.fill_diagonal(close, False)
    comps = Union(ids)
    for a, b in zip(*np.nonzero(close), strict=True):
        comps.join(ids[a], ids[b])
    return {i: (int(close[k].sum()), comps.find(i)) for k, i in enumerate(ids)}
