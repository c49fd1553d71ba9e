"""Patience diff of repeated lines."""

import itertools
import random

import pytest

from bramble.llm import line_dedup
from helpers import documents


def test_excerpt_after_a_repeated_line(spark):
    rows = [(1, "x\nL\ny\nL\nz 1\nz 2"), (2, "L\nz 1\nz 2")]
    assert {r.doc_id: r.text for r in line_dedup.keep_new_lines(documents(spark, rows)).collect()} == {1: rows[0][1], 2: ""}


@pytest.mark.parametrize("later, earlier, want", [
    ("L z", "x L y L z", [(0, 3), (1, 4)]),            # beside the anchor that follows
    ("q L z", "q p L r L z", [(0, 0), (1, 4), (2, 5)]),
    ("a L L b", "a L c L L b", [(0, 0), (1, 1), (2, 4), (3, 5)]),
    ("L M w", "L M r L M v", [(0, 0), (1, 1)]),
    ("", "a", []),
])
def test_patience_gaps(later, earlier, want):
    assert line_dedup.patience(later.split(), earlier.split()) == want


@pytest.mark.parametrize("held", [1 << 28, 20])
def test_common_subsequence_equals_brute_force(monkeypatch, held):
    monkeypatch.setattr(line_dedup, "HELD_BITS", held)
    rng = random.Random(2)
    for _ in range(300):
        a, b = ([rng.randrange(3) for _ in range(rng.randrange(9))] for _ in range(2))
        got = line_dedup.common_subsequence(a, b)
        assert all(a[i] == b[j] for i, j in got) and all(x < y and u < v for (x, u), (y, v) in zip(got, got[1:]))
        subs = {c for n in range(len(b) + 1) for c in itertools.combinations(b, n)}
        assert len(got) == max(n for n in range(len(a) + 1) for c in itertools.combinations(a, n) if c in subs)
