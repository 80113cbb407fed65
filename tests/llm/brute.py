"""Plain Python versions of what the operators compute."""

from __future__ import annotations

import base64
import hashlib
import math
import re
import zlib
from collections import defaultdict

import duckdb


def rows(sf: str, sql: str) -> list[tuple]:
    con = duckdb.connect()
    for t in ("documents", "pages", "embeddings"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    return con.execute(sql).fetchall()


def runs(words: list, n: int = 5) -> frozenset:
    if len(words) < n:
        return frozenset([tuple(words)] if words else [])
    return frozenset(tuple(words[i:i + n]) for i in range(len(words) - n + 1))


def overlaps(sets: list[frozenset]):
    """(later, earlier, common) of all pairs that share anything."""
    where = defaultdict(list)
    for i, s in enumerate(sets):
        common = defaultdict(int)
        for g in s:
            for j in where[g]:
                common[j] += 1
            where[g].append(i)
        for j, k in common.items():
            yield i, j, k


def components(docs: list[tuple]) -> dict:
    """doc_id -> (n_shingles, component_id, kept) for (doc_id, text)."""
    sets = [runs(re.findall(rb"[^\x20\x09-\x0D]+", (t or "").encode().lower())) for _, t in docs]
    parent = list(range(len(docs)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, j, k in overlaps(sets):
        if 100 * k >= 75 * (len(sets[i]) + len(sets[j]) - k):
            a, b = find(i), find(j)
            if a != b:
                parent[max(a, b, key=lambda x: docs[x][0])] = min(a, b, key=lambda x: docs[x][0])
    return {d: (len(s), docs[find(i)][0], docs[find(i)][0] == d) for i, ((d, _), s) in enumerate(zip(docs, sets, strict=True))}


def repeated_lines(docs: list[tuple]) -> dict:
    """doc_id -> line numbers to remove, for (doc_id, text) in order."""
    lines = [(d, i, runs(w)) for d, t in docs for i, line in enumerate((t or "").split("\n"))
             if (w := re.findall(r"[^\x20\x09-\x0D]+", line.lower()))]
    gone = {i for i, j, k in overlaps([s for _, _, s in lines])
            if 4 * k >= 3 * (len(lines[i][2]) + len(lines[j][2]) - k)}
    out = defaultdict(list)
    for i in sorted(gone):
        out[lines[i][0]].append(lines[i][1])
    return dict(out)


def nearest(vectors: list[tuple], queries: set, k: int = 20) -> dict:
    """(query, rank) -> (id, inner product added up in order)."""
    out = {}
    for q, x in vectors:
        if q in queries:
            scored = []
            for c, y in vectors:
                if c != q and len(x) == len(y):
                    total = 0 * x[0] if x else 0
                    for a, b in zip(x, y, strict=True):
                        total += a * b
                    scored.append((-total, c))
            out |= {(q, r + 1): (c, -s) for r, (s, c) in enumerate(sorted(scored)[:k])}
    return out


def usable(v) -> bool:
    return v is not None and all(x is not None and math.isfinite(x) for x in v)


def archive(pages: list[tuple], least: int = 0) -> dict:
    """page_id -> (bytes, digest, type, refers_to) for (page_id, html)."""
    by = defaultdict(list)
    for p, h in pages:
        by[(h or "").encode()].append(p)
    out = {}
    for raw, ids in by.items():
        digest = base64.b32encode(hashlib.sha1(raw).digest()).decode()
        for p in ids:
            original = p == max(ids) or len(raw) < least
            out[p] = (len(raw), digest, "response" if original else "revisit", None if original else max(ids))
    return out


def crc(ids: list[int]) -> int:
    return zlib.crc32(b"".join(i.to_bytes(4, "little") for i in ids))
