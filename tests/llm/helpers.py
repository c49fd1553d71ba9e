"""Brute-force versions and odd inputs for the tests of the training-data operators."""

from __future__ import annotations

import hashlib

import numpy as np
import xxhash

LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))


def words(text: str | None) -> list[bytes]:
    return (text or "").encode().split()


def fingerprint(text: str | None, size: int = 4) -> int:
    w = (text or "").encode().translate(LOWER).split()
    if not w:
        return 0
    grams = [b" ".join(w[i:i + size]) for i in range(max(1, len(w) - size + 1))]
    ones = np.zeros(64, int)
    for g in grams:
        h = xxhash.xxh64_intdigest(g, 42)
        ones += [h >> b & 1 for b in range(64)]
    return sum(1 << b for b in range(64) if 2 * ones[b] > len(grams))


def components(nodes, linked) -> dict:
    """Smallest reachable node by union-find over all pairs."""
    nodes = list(nodes)
    parent = {n: n for n in nodes}

    def find(n):
        while parent[n] != n:
            n = parent[n]
        return n

    for i, a in enumerate(nodes):
        for b in nodes[i + 1:]:
            if linked(a, b):
                x, y = sorted((find(a), find(b)))
                parent[y] = x
    return {n: find(n) for n in nodes}


def without_repeats(texts: dict, window: int) -> dict:
    """doc_id -> (n_words, n_removed, sha256 of the words that stay)."""
    owner: dict = {}
    split = {d: words(t) for d, t in texts.items()}
    for d in sorted(split):
        for i in range(len(split[d]) - window + 1):
            owner.setdefault(tuple(split[d][i:i + window]), d)
    out = {}
    for d, w in split.items():
        gone = [False] * len(w)
        for i in range(len(w) - window + 1):
            if owner[tuple(w[i:i + window])] < d:
                gone[i:i + window] = [True] * window
        kept = [x for x, g in zip(w, gone) if not g]
        out[d] = (len(w), sum(gone), hashlib.sha256(b" ".join(kept)).hexdigest())
    return out


def documents(spark, rows):
    """documents with an extra column whose name the operators use inside."""
    return spark.createDataFrame([(d, t, "en", "src", len(t or ""), "extra", "sig") for d, t in rows],
                                 "doc_id long, text string, lang string, source string, n_chars long, key string, sig string")


def odd_rows():
    """Nulls, empty and blank texts, ties, repeated rows, a very long text, odd characters."""
    long = " ".join(f"w{i % 977}x{i // 977}" for i in range(30000))
    base = " ".join(f"alpha{i}" for i in range(80))
    return [(1, None), (2, ""), (3, " \t\n\x0b"), (4, base), (5, base), (5, base), (None, base), (6, base + " tail"),
            (7, long), (8, long + " end"), (9, "é漢字 ▁ 🙂\u0000 x\xa0y z"), (10, "one two"), (11, "ONE two"),
            (None, None), (12, "a\n\na\na"), (13, base.upper()), (2 ** 62, "All rights reserved. CC BY")]
