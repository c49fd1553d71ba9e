"""Packing of tokenised documents into fixed-length sequences: first-fit decreasing with a
tournament tree of bin capacities, run independently in randomised groups of documents.

Texts are dealt into groups by a hash of doc_id and text (a hash of the text too, so that
repeated doc_ids spread); a group is packed by one task, and a task packs its groups one after
the other, in sub-groups of ``group_docs`` documents or ``group_tokens`` tokens where a group
holds more, so memory does not depend on the data. Of a document, whole sequences are cut
off first; the rests are placed in falling size, each into the first bin that has room, which
the tree finds in log(bins) steps. Bins that stay open are then filled by cutting the least
filled bins up, so that one bin a group at most is short; its rest is cut into sequences
whose lengths are powers of two, which need no padding.

Token ids come from the byte-level BPE vocabulary; the fast ``tiktoken`` reader of the same
vocabulary gives the same ids as ``tokenizers`` (a test compares them), with its one special
token read where its string stands in a text, as there. Where its matcher gives up (runs of
white space of a million characters), ``tokenizers`` reads the text. Every document ends with
id 0.

Null text counts as empty (id 0 alone); repeated rows and null doc_ids are packed like
others; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import base64
import zlib
from dataclasses import dataclass

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from bramble.llm.shared import batches, record_batch, utf8, whole_text

LENGTH = 1024
END = 0


def tokenizer(ranks_path: str | None = None):
    import tiktoken
    with open(ranks_path or public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb") as f:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}
    return tiktoken.Encoding("byte_bpe_50k", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks,
                             special_tokens={"<|endoftext|>": 50256})


class Encoder:
    """Ids of a text by the fast reader, or by ``tokenizers`` where its matcher runs out of stack."""

    def __init__(self, ranks_path: str | None = None, json_path: str | None = None):
        self.fast, self.json_path, self.slow = tokenizer(ranks_path), json_path, None

    def __call__(self, text: str) -> list[int]:
        try:
            return self.fast.encode(text, allowed_special="all")
        except ValueError:
            if self.slow is None:
                from tokenizers import Tokenizer
                self.slow = Tokenizer.from_file(self.json_path or public_tokenizers.path("byte_bpe_50k.json"))
            return self.slow.encode(text, add_special_tokens=False).ids


class Tournament:
    """First bin with room: leaves hold the room of each bin, parents the larger child's."""

    def __init__(self, bins: int, length: int):
        self.leaves = 1 << max(0, (bins - 1).bit_length())
        self.room = [length] * (2 * self.leaves)

    def place(self, size: int) -> int:
        """Index of the leftmost bin with at least ``size`` of room, which it takes up."""
        room, i = self.room, 1
        while i < self.leaves:
            i *= 2
            if room[i] < size:
                i += 1
        room[i] -= size
        leaf = i - self.leaves
        while i > 1:
            i //= 2
            room[i] = max(room[2 * i], room[2 * i + 1])
        return leaf


@dataclass
class Piece:
    doc: int
    start: int
    length: int


def first_fit_decreasing(rests: list[Piece], length: int) -> list[list[Piece]]:
    tree = Tournament(max(1, len(rests)), length)
    bins: list[list[Piece]] = []
    for p in sorted(rests, key=lambda p: (-p.length, p.doc)):
        b = tree.place(p.length)
        if b == len(bins):
            bins.append([])
        bins[b].append(p)
    return bins


def fill_up(bins: list[list[Piece]], length: int) -> list[list[Piece]]:
    """Full sequences, then one rest in powers of two: the pieces of the least filled bins are
    moved, and cut where they must be, into the gaps of the fuller ones."""
    size = {id(b): sum(p.length for p in b) for b in bins}
    full = [b for b in bins if size[id(b)] == length]
    short = sorted((b for b in bins if size[id(b)] < length), key=lambda b: -size[id(b)])
    while len(short) > 1:
        gap, donor = length - size[id(short[0])], short[-1]
        while gap and donor:
            p = donor.pop()
            take = min(gap, p.length)
            short[0].append(Piece(p.doc, p.start, take))
            if take < p.length:
                donor.append(Piece(p.doc, p.start + take, p.length - take))
            gap -= take
            size[id(donor)] -= take
        size[id(short[0])] = length - gap
        if not donor:
            short.pop()
        if gap == 0:
            full.append(short.pop(0))
    for b in short:  # one at most
        full += powers_of_two(b)
    return full


def powers_of_two(pieces: list[Piece]) -> list[list[Piece]]:
    left, out = list(pieces), []
    total = sum(p.length for p in pieces)
    while total:
        want = 1 << (total.bit_length() - 1)
        total -= want
        out.append([])
        while want:
            p = left.pop(0)
            take = min(want, p.length)
            out[-1].append(Piece(p.doc, p.start, take))
            if take < p.length:
                left.insert(0, Piece(p.doc, p.start + take, p.length - take))
            want -= take
    return out


def pack_group(lengths: list[int], length: int = LENGTH) -> list[list[Piece]]:
    """Sequences of pieces (document index, start, length) that cover every token once."""
    whole, rests = [], []
    for d, n in enumerate(lengths):
        cut = n - n % length
        whole += [[Piece(d, s, length)] for s in range(0, cut, length)]
        if n > cut:
            rests.append(Piece(d, cut, n - cut))
    return whole + fill_up(first_fit_decreasing(rests, length), length)


def pack(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH,
         group_docs: int = 512, group_tokens: int = 1 << 22, ranks_path: str | None = None,
         json_path: str | None = None) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset."""
    groups = max(1, -(-docs.count() // group_docs))
    id_type = docs.schema[id_col].dataType.simpleString()
    dealt = (docs.select(F.col(id_col).alias("doc_id"), whole_text(text_col).alias("text"))
             .withColumn("group", F.pmod(F.xxhash64("doc_id", "text"), F.lit(groups)))
             .repartition("group").sortWithinPartitions("group"))
    names = ["start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    schema = pa.schema([(n, pa.int64()) for n in names])

    def run(it):
        encode = Encoder(ranks_path, json_path)
        group, next_id, ids, tokens, held = None, 0, [], [], 0

        def packed():
            rows, docs_of = [], []
            for k, sequence in enumerate(pack_group([len(t) for t in tokens], length)):
                offset = 0
                for p in sequence:
                    crc = zlib.crc32(tokens[p.doc][p.start:p.start + p.length].tobytes())
                    rows.append((p.start, p.length, crc, len(tokens[p.doc]), (group << 32) + next_id + k, offset))
                    docs_of.append(ids[p.doc])
                    offset += p.length
            cols = record_batch(schema, list(zip(*rows))).columns
            return pa.RecordBatch.from_arrays([pa.array(docs_of, id_arrow), *cols], names=["doc_id", *names]), 1 + k

        for b in batches(it):
            id_arrow = b.schema.field("doc_id").type
            for doc_id, text, g in zip(*(b.column(i).to_pylist() for i in range(3))):
                if tokens and (g != group or len(tokens) >= group_docs * 2 or held >= group_tokens):
                    out, used = packed()
                    yield out
                    next_id, ids, tokens, held = (next_id + used if g == group else 0), [], [], 0
                group = g
                t = np.array([*encode(utf8(text).decode("utf-8", "replace")), END], "<u4")
                ids.append(doc_id)
                tokens.append(t)
                held += len(t)
        if tokens:
            yield packed()[0]

    return dealt.mapInArrow(run, f"doc_id {id_type}, " + ", ".join(f"{n} bigint" for n in names))
