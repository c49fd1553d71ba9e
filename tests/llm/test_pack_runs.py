"""Packing of texts with very long runs of one character."""

from functools import cache

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from bramble.llm import packing
from helpers import documents
from test_html_pack_code import check_pieces


@pytest.mark.parametrize("run", [" ", "a", "\n", "\t "])
def test_runs_of_a_million(spark, run):
    rows = [(1, "a" + run * (1_000_000 // len(run)) + "b"), (2, "short"), (3, None)]
    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    got = packing.pack(documents(spark, rows)).collect()
    check_pieces(rows, got, cache(lambda s: t.encode(s, add_special_tokens=False).ids))
