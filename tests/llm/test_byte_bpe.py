"""Byte-level BPE against the tiktoken library: all code points, random mixes, long runs."""

import base64
import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
import tiktoken

from bramble.llm import byte_bpe, queries
from conftest import SF_SMALL
from helpers import documents, odd_rows
from oracle_harness import duck


@pytest.fixture(scope="module")
def library():
    with open(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


@pytest.fixture(scope="module")
def codec():
    return byte_bpe.Codec()


def check(codec, library, texts):
    ids, offsets, counts = codec.encode(texts)
    at = np.concatenate([[0], np.cumsum(counts)])
    for k, t in enumerate(texts):
        own = ids[at[k]:at[k + 1]].tolist()
        assert own == library.encode_ordinary(t), t[:80]
        want = library.decode_tokens_bytes(own)
        assert offsets[at[k]:at[k + 1]].tolist() == np.cumsum([0, *map(len, want)])[:-1].tolist()
    for kept in (None, offsets):
        out, sizes = codec.decode(ids, counts, kept)
        assert out.tobytes() == "".join(texts).encode() and sizes.tolist() == [len(t.encode()) for t in texts]


def test_random_mixes(codec, library):
    rng = random.Random(5)
    parts = ["a", "Zz", "é", "漢字", "1", "²", "!", "'", "'s", "'S", "'re", "'r", "'ll", "'d", "'ve", " ", "  ", "\n", "\t", "\r\n", " ",
             "　", " ", "🙂", "́", "\x00", "<|endoftext|>", "_", "’s", "﻿", "​", "\x1c", "\x85"]
    check(codec, library, ["".join(rng.choice(parts) for _ in range(rng.randrange(0, 40))) for _ in range(4000)])


def test_every_code_point(codec, library):
    """Each between letters, behind a blank, behind a number and beside itself."""
    points = [chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    texts = ["".join(f"a{c} {c}1{c}{c}\n{c}" for c in points[i:i + 500]) for i in range(0, 0x3400, 500)]
    texts += ["".join(f"a{c} {c}1{c}{c}\n{c}" for c in points[i:i + 500]) for i in range(0xA000, len(points), 9973)]
    check(codec, library, texts)
    kind = codec.scan.kind
    assert kind[0x41] == byte_bpe.LETTER and kind[0x35] == byte_bpe.NUMBER and kind[0x3000] == byte_bpe.LAST


def test_windows_do_not_matter(codec, library, monkeypatch):
    rng = random.Random(6)
    texts = ["".join(rng.choice(["a", "'ll", "'s", " ", "  ", "\n", "1", "é", "!", "🙂"]) for _ in range(rng.randrange(0, 60))) for _ in range(300)]
    for size in (1, 2, 3, 7, 64):
        monkeypatch.setattr(byte_bpe, "WINDOW", size)
        check(codec, library, texts)


def test_prefix_scan_is_the_sequential_one(codec):
    rng = np.random.default_rng(1)
    scan = codec.scan
    symbols = rng.integers(0, 9, 10000)
    got = scan.state[scan.prefixes(scan.symbol[symbols]), byte_bpe.FREE]
    nxt, _ = byte_bpe._transitions()
    state, want = byte_bpe.FREE, []
    for s in symbols:
        state = nxt[s, state]
        want.append(state)
    assert got.tolist() == want


def test_long_runs_and_long_matches(codec, library):
    rng = random.Random(7)
    check(codec, library, ["a" * 3000, " " * 3000 + "b", "é" * 500, "\n" * 2000, "".join(rng.choice("abcdehinorst") for _ in range(5000)), "=" * 4000])
    for c in "a \n":  # beyond what the library's matcher takes
        text = "x" + c * 1_000_000 + "y"
        ids, _, counts = codec.encode([text])
        assert codec.decode(ids, counts)[0].tobytes() == text.encode()


def brute(library, rows):
    out = []
    for d, t in rows:
        ids = library.encode_ordinary(t or "")
        out.append((d, len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256((t or "").encode()).hexdigest()))
    return sorted(out, key=str)


def test_query_equals_library(spark, library):
    rows = duck(SF_SMALL).execute("select doc_id, text from documents").fetchall()
    got = queries.op12_byte_bpe(spark, SF_SMALL)
    assert [(f.name, f.dataType.simpleString()) for f in got.schema] == [
        ("doc_id", "bigint"), ("n_tokens", "bigint"), ("ids_sha256", "string"), ("decoded_sha256", "string")]
    assert sorted(map(tuple, got.collect()), key=str) == brute(library, rows)


def test_odd_rows(spark, library):
    docs = documents(spark, odd_rows())
    assert sorted(map(tuple, byte_bpe.digests(docs).collect()), key=str) == brute(library, odd_rows())
    assert byte_bpe.digests(docs.limit(0)).count() == 0
    coded = byte_bpe.decode(byte_bpe.encode(docs))
    assert coded.columns == [*docs.columns, "ids", "offsets", "decoded"]
    for r in coded.collect():
        assert (r.ids is None and r.decoded is None) if r.text is None else bytes(r.decoded) == r.text.encode()
