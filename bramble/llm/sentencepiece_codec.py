"""SentencePiece encoding and decoding: an Aho-Corasick automaton over the pieces drives a
single-pass Viterbi.

The pieces and scores are those of a public model file (its path is a parameter). A text is
one segmentation into pieces of the greatest total score: the automaton reads it once, and
at every position its output links name all pieces that end there, each of which relaxes the
best score at its end. Characters that are no piece of their own become the byte pieces of
their UTF-8, at a score below any piece. Ties go to the longer last piece.

Blanks are written as U+2581 with one in front of the text, as in the model; a U+2581 of the
text itself goes through byte pieces, so decoding gives every text back exactly. No piece
crosses from another character into a blank, and none holds a line break or tab, so a text
falls into stretches (blanks and the characters up to the next blank, or one break) whose
best segmentations join to the best of the whole.
Different stretches of a batch are segmented once, many at a time. A model with pieces that
do cross is read without this cut.

Null text has no ids (null) and decodes to null; empty text has none and decodes to empty;
repeated rows and null doc_ids are coded like others; an empty table gives an empty result;
other columns are not read.
"""

from __future__ import annotations

import re
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame, functions as F

from bramble.llm.shared import batches

BLANK = "▁"
OWN_BLANK = "\udc81"  # stands for a U+2581 of the text; never in valid UTF-8
SHORT = 48
ALPHABET = 160
TOGETHER = 8192


class Automaton:
    """Aho-Corasick automaton with all transitions in one table, over the pieces made of the
    ``ALPHABET`` most used characters; reads many stretches at once, one position a step."""

    def __init__(self, pieces: dict[str, tuple[int, float]]):
        used = Counter(c for p in pieces for c in set(p))
        self.chars = {c for c, _ in used.most_common(ALPHABET) if c in pieces}
        self.code = np.zeros(0x110000, np.uint8)
        for k, c in enumerate(sorted(self.chars)):
            self.code[ord(c)] = k + 1
        code = {c: int(self.code[ord(c)]) for c in self.chars}
        children: list[dict[int, int]] = [{}]
        ends: list[str | None] = [None]
        for p in pieces:
            if self.chars.issuperset(p):
                at = 0
                for c in p:
                    nxt = children[at].get(code[c])
                    if nxt is None:
                        nxt = children[at][code[c]] = len(children)
                        children.append({})
                        ends.append(None)
                    at = nxt
                ends[at] = p
        n = len(children)
        self.piece = np.array([pieces[p][0] if p else -1 for p in ends], np.int32)
        self.score = np.array([pieces[p][1] if p else 0.0 for p in ends])
        self.size = np.array([len(p) if p else 0 for p in ends], np.int32)
        self.next = np.zeros((n, len(self.chars) + 1), np.int32)
        fail, self.link = np.zeros(n, np.int32), np.zeros(n, np.int32)  # link: next shorter piece that ends here
        order = [0]
        for at in order:
            own = children[at]
            self.next[at] = self.next[fail[at]] if at else 0
            for c, child in own.items():
                fail[child] = self.next[fail[at], c] if at else 0
                self.next[at, c] = child
                f = fail[child]
                self.link[child] = f if self.piece[f] >= 0 else self.link[f]
                order.append(child)
        self.first = np.where(self.piece >= 0, np.arange(n), self.link).astype(np.int32)

    def viterbi(self, parts: list[str]) -> list[bytes]:
        """Best segmentations as int32 bytes; every character must be in ``chars``."""
        length = np.array([len(p) for p in parts])
        n, width = len(parts), int(length.max())
        text = "".join([p.ljust(width, "\0") for p in parts]).encode("utf-32-le")
        code = self.code[np.frombuffer(text, np.uint32)].reshape(n, width)
        best = np.full((n, width + 1), -np.inf)
        best[:, 0] = 0
        back = np.zeros((n, width + 1), np.int32)  # automaton state of the piece taken
        state = np.zeros(n, np.int32)
        for p in range(width):
            state = self.next[state, code[:, p]]
            out = self.first[state]
            rows = np.flatnonzero(out)
            while len(rows):  # output links, longest piece first
                piece = out[rows]
                at = best[rows, p + 1 - self.size[piece]] + self.score[piece]
                better = at > best[rows, p + 1]
                best[rows[better], p + 1], back[rows[better], p + 1] = at[better], piece[better]
                out[rows] = self.link[piece]
                rows = rows[out[rows] > 0]
        ids = np.zeros((n, width), np.int32)
        at, count, rows = length.copy(), np.zeros(n, np.int64), np.arange(n)
        while len(rows):
            piece = back[rows, at[rows]]
            count[rows] += 1
            ids[rows, width - count[rows]] = self.piece[piece]
            at[rows] -= self.size[piece]
            rows = rows[at[rows] > 0]
        flat = ids[np.arange(width) >= (width - count)[:, None]].tobytes()
        ends = np.concatenate([[0], np.cumsum(4 * count)]).tolist()
        return [flat[a:b] for a, b in zip(ends, ends[1:])]


class Codec:
    """Encoder and decoder of one model file; built once a task."""

    def __init__(self, path: str | None = None):
        import ahocorasick
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path or public_tokenizers.path("piece_bpe_32k.model"))
        size = model.get_piece_size()
        self.bytes: dict[int, int] = {}
        self.raw: list[bytes] = []
        self.automaton = ahocorasick.Automaton()
        self.single: set[str] = set()
        plain: dict[str, tuple[int, float]] = {}
        crosses = False
        for i in range(size):
            piece = model.id_to_piece(i)
            if model.is_byte(i):
                self.bytes[int(piece[3:5], 16)] = i
                self.raw.append(bytes([int(piece[3:5], 16)]))
                continue
            if model.is_control(i) or model.is_unknown(i):
                self.raw.append(b"")
                continue
            self.raw.append(piece.replace(BLANK, " ").encode())
            self.automaton.add_word(piece, (len(piece), i, model.get_score(i)))
            plain[piece] = (i, model.get_score(i))
            if len(piece) == 1:
                self.single.add(piece)
            crosses |= BLANK in piece.lstrip(BLANK)
        self.automaton.make_automaton()
        self.many = Automaton(plain)
        self.unknown = -size - 10.0
        apart = "".join(c for c in "\t\n\x0b\x0c\r" if not any(c in p for p in plain))
        self.stretches = re.compile("(?s).+" if crosses else f"{BLANK}*[^{BLANK}{apart}]+|{BLANK}+" + (f"|[{apart}]" if apart else ""))
        self.raw_bytes = np.frombuffer(b"".join(self.raw), np.uint8)
        self.raw_size = np.array([len(r) for r in self.raw], np.int64)
        self.raw_start = np.concatenate([[0], np.cumsum(self.raw_size)[:-1]])

    def viterbi(self, s: str) -> list[int]:
        """Ids of the best segmentation of one stretch of any characters and length."""
        n = len(s)
        best, length_at, piece_at = [0.0] + [float("-inf")] * n, [1] * (n + 1), [-1] * (n + 1)
        if self.single.issuperset(s):
            unknown = []
        else:
            unknown = [i + 1 for i, c in enumerate(s) if c not in self.single][::-1]  # ends of byte characters
        for end, (length, piece, score) in self.automaton.iter(s):
            end += 1
            while unknown and unknown[-1] <= end:  # settles all positions before this end
                at = unknown.pop()
                best[at] = best[at - 1] + self.unknown
            at = best[end - length] + score
            if at > best[end]:
                best[end], length_at[end], piece_at[end] = at, length, piece
        out, i = [], n
        while i:
            length, piece = length_at[i], piece_at[i]
            if piece >= 0:
                out.append(piece)
            else:
                c = BLANK if s[i - 1] == OWN_BLANK else s[i - 1]
                out.extend(self.bytes[b] for b in reversed(c.encode("utf-8", "surrogatepass")))
            i -= length
        return out[::-1]

    def cut(self, text: str) -> list[str]:
        s = BLANK + text.replace(BLANK, OWN_BLANK).replace(" ", BLANK)
        return self.stretches.findall(s) if text else []

    def segment(self, parts: set[str]) -> dict[str, bytes]:
        """Ids of each stretch as int32 bytes: short ones of common characters together, the
        others one by one."""
        usual = self.many.chars.issuperset
        plain = sorted((p for p in parts if len(p) <= SHORT and usual(p)), key=len)
        out: dict[str, bytes] = {}
        for i in range(0, len(plain), TOGETHER):  # sorted by length: little padding
            some = plain[i:i + TOGETHER]
            out.update(zip(some, self.many.viterbi(some)))
        for p in parts:
            if p not in out:
                out[p] = np.array(self.viterbi(p), np.int32).tobytes()
        return out

    def encode(self, text: str) -> list[int]:
        return self.encode_column(pa.array([text]))[0].as_py()

    def decode(self, ids: list[int]) -> str:
        raw = self.raw
        return b"".join([raw[i] for i in ids]).decode("utf-8", "replace")[1:]

    def encode_column(self, texts: pa.Array) -> pa.Array:
        cuts = [None if t is None else self.cut(t) for t in texts.to_pylist()]
        ids_of = self.segment(set().union(*(c for c in cuts if c))).__getitem__
        made = [None if c is None else b"".join(map(ids_of, c)) for c in cuts]
        ends = np.concatenate([[0], np.cumsum([len(m or b"") // 4 for m in made])])
        ids = np.frombuffer(b"".join([m for m in made if m]), np.int32)
        return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(ids), mask=pa.array([m is None for m in made]))

    def decode_column(self, lists: pa.Array) -> pa.Array:
        """All lists at once: the bytes of every id are copied to their places."""
        none = np.array(lists.is_null())
        counts = np.where(none, 0, np.array(lists.value_lengths().fill_null(0)))
        ids = np.array(lists.flatten())
        size = self.raw_size[ids]
        to = np.concatenate([[0], np.cumsum(size)])
        source = np.repeat(self.raw_start[ids] - to[:-1], size) + np.arange(to[-1])
        joined = self.raw_bytes[source]
        at = to[np.concatenate([[0], np.cumsum(counts)])]
        # the blank that stands in front of every text is dropped
        first = np.minimum(at[:-1] + 1, at[1:])
        keep = np.ones(len(joined), bool)
        keep[at[:-1][first > at[:-1]]] = False
        ends = np.concatenate([[0], np.cumsum(at[1:] - first)])
        out = pa.Array.from_buffers(pa.large_string(), len(none), [None, pa.py_buffer(ends.astype(np.int64)), pa.py_buffer(joined[keep])])
        try:
            out.validate(full=True)
        except pa.ArrowInvalid:  # ids that no text gives
            return pa.array([None if v is None else self.decode(v) for v in lists.to_pylist()], pa.string())
        empty = pa.scalar(None, pa.large_string())
        return pa.compute.if_else(pa.array(none), empty, out).cast(pa.string())


def _mapped(df: DataFrame, source: str, target: str, kind: str, method: str, path: str | None) -> DataFrame:
    def run(it):
        code = getattr(Codec(path), method)
        for b in batches(it):
            yield pa.RecordBatch.from_arrays([*b.columns, code(b.column(source))], names=[*b.schema.names, target])

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields)
    return df.mapInArrow(run, f"{fields}, `{target}` {kind}")


def encode(df: DataFrame, text_col: str = "text", ids_col: str = "ids", model_path: str | None = None) -> DataFrame:
    """``df`` and its texts' piece ids (array<int>)."""
    return _mapped(df, text_col, ids_col, "array<int>", "encode_column", model_path)


def decode(df: DataFrame, ids_col: str = "ids", text_col: str = "decoded", model_path: str | None = None) -> DataFrame:
    """``df`` and the texts of its ids."""
    return _mapped(df, ids_col, text_col, "string", "decode_column", model_path)


def round_trip(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", model_path: str | None = None) -> DataFrame:
    """One row per document: doc_id, n_ids, ids_hash, n_code_points, same (decoded text is the text)."""
    picked = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    coded = decode(encode(picked, model_path=model_path), model_path=model_path)
    return coded.select("doc_id", F.coalesce(F.size("ids"), F.lit(0)).cast("long").alias("n_ids"), F.xxhash64("ids").alias("ids_hash"),
                        F.coalesce(F.char_length("text"), F.lit(0)).cast("long").alias("n_code_points"),
                        F.col("decoded").eqNullSafe(F.col("text")).alias("same"))
