"""Line dedup against the alignment of all pairs of documents, whatever their lines' frequency."""

import random

import pytest

from bramble.llm import line_dedup
from conftest import SF_MID, SF_SMALL
from helpers import documents
from oracle_harness import duck


def worded(text):
    return [x for x in (text or "").split("\n") if x.encode().split()]


def brute_all_pairs(texts: dict) -> dict:
    """Every later document aligned with every earlier one that has a line of it."""
    own = {d: worded(t) for d, t in texts.items()}
    out, order = {}, sorted(texts)
    for n, d in enumerate(order):
        lines, gone = set(own[d]), set()
        words = [len(x.encode().split()) for x in own[d]]
        for o in order[:n]:
            if not lines.isdisjoint(own[o]):
                gone.update(line_dedup.pair_cut([x.encode() for x in own[d]], words, [x.encode() for x in own[o]], line_dedup.MIN_WORDS))
        p, kept = -1, []
        for x in (texts[d] or "").split("\n"):
            p += bool(x.encode().split())
            if not (x.encode().split() and p in gone):
                kept.append(x)
        out[d] = "\n".join(kept)
    return out


def cut(spark, rows):
    return {r.doc_id: r.text for r in line_dedup.keep_new_lines(documents(spark, rows)).collect()}


def test_copy_with_frequent_lines_goes(spark):
    copy = "a = 1\n}\nb = 2\n}\nc = 3"
    rows = [(d, f"own {d}\n}}\nmore {d}\n}}") for d in range(1, 6)] + [(10, copy), (20, copy)]
    assert cut(spark, rows)[20] == ""


def test_block_of_frequent_short_lines_goes(spark):
    rows = [(1, "one two three"), (2, "four five six")] + [(d, f"own {d}\none two three\nfour five six") for d in range(3, 9)]
    out = cut(spark, rows)
    assert out[3] == rows[2][1] and all(out[d] == f"own {d}" for d in range(4, 9))


def test_frequent_line_that_crosses_its_first_holder_goes(spark):
    """The earliest holder of the line has it in another order, a later one does not."""
    common = "a very common line of all these texts"
    block = "\n".join(f"line {i} of the long shared block" for i in range(3))
    rows = [(1, f"{common}\n{block}"), *((d, f"own text {d}\n{common}") for d in range(2, 40)), (50, f"{block}\n{common}")]
    assert cut(spark, rows)[50] == ""


def test_random_texts_equal_all_pairs(spark):
    rng = random.Random(4)
    pool = ["{", "}", "x y", "one two three", "a line of five words", "another line of five words", *(f"rare {i} text" for i in range(40))]
    rows = [(d, "\n".join(pool[min(int(rng.expovariate(0.15)), len(pool) - 1)] for _ in range(rng.randrange(1, 12)))) for d in range(150)]
    assert cut(spark, rows) == brute_all_pairs(dict(rows))


@pytest.mark.parametrize("sf", [SF_SMALL, SF_MID])
def test_documents_equal_all_pairs(spark, sf):
    texts = dict(duck(sf).execute("select doc_id, text from documents").fetchall())
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    got = {r.doc_id: r.text for r in line_dedup.keep_new_lines(docs).collect()}
    assert got == brute_all_pairs(texts)
