"""Byte-level BPE encoding and decoding: pre-tokenisation by vectorised scans, cached merging.

The usual splitting pattern (contractions, letters, numbers, other characters, white space) is
read as an automaton of eight states over nine symbols. A symbol is the class of a code point
(an array over all code points) together with a look at the next two. Each symbol is a
transition function from states to states; the functions that symbols make in sequence are
few, so they are numbered once and their composition is a table. A prefix scan over that
table (associative, block by block in numpy) gives the state at every position at once, and
with it every place where a match starts: no regular expression is run over a text, so no
text can exhaust a matcher's stack. Matches are slices of the UTF-8 bytes; each different one
is merged by rank once and kept in a bounded cache. Code points have the classes of the
``tiktoken`` reader, which is asked once on the driver.

``encode`` gives ids and the byte offset of each id's first byte; ``decode`` copies the bytes
of every id to its offset. Windows of code points and slices of matches bound the memory
beyond a text's own bytes, ids and offsets, whatever its length.

Null text has null ids and decodes to null (the digest query counts it as empty); empty text
has no ids and decodes to empty; strings of special tokens are ordinary text; repeated rows
and null doc_ids are coded like others; an empty table gives an empty result; other columns
are carried by ``encode`` and ``decode``, and not read by the digest query.
"""

from __future__ import annotations

import base64
import heapq
from functools import lru_cache

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from bramble.llm.shared import batches, whole_text

# The pattern that the automaton stands for; a library with another one is refused.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""

LETTER, NUMBER, OTHER, SHORT, LONG, MIDDLE, BLANK, LAST, BREAK = range(9)  # symbols
FREE, LETTERS, NUMBERS, OTHERS, SPACES, PREFIX, ONE_LEFT, TWO_LEFT = range(8)  # states
END_OF_TEXT = 0x110000
WINDOW = 1 << 19  # code points scanned at once
SLICE = 1 << 18  # matches or ids handled at once
BLOCK = 64  # positions of a block of the scan
CACHED_BYTES = 1 << 22  # matches kept, by their bytes
TOGETHER_BYTES = 48  # matches up to this length are merged side by side
TOGETHER = 4096


@lru_cache(1)
def class_runs() -> tuple[tuple[int, ...], tuple[int, ...]]:
    """(first code point, class) of each run of code points with the same class, as the
    ``tiktoken`` reader classes them; LAST stands for white space."""
    import tiktoken
    points = [c for c in range(END_OF_TEXT) if not 0xD800 <= c < 0xE000]
    every = "".join(map(chr, points))
    table = np.full(END_OF_TEXT + 1, OTHER, np.uint8)
    for pattern, kind in ((r"\p{L}", LETTER), (r"\p{N}", NUMBER), (r"\s", LAST)):
        reader = tiktoken.Encoding("class", pat_str=pattern, mergeable_ranks={bytes([b]): b for b in range(256)}, special_tokens={})
        found = bytes(reader.encode_ordinary(every)).decode()
        table[np.frombuffer(found.encode("utf-32-le"), np.uint32)] = kind
    table[END_OF_TEXT] = BREAK
    first = np.flatnonzero(np.diff(table, prepend=255))
    return tuple(first.tolist()), tuple(table[first].tolist())


def _transitions() -> tuple[np.ndarray, np.ndarray]:
    """(next state, whether a match starts) by symbol and state before."""
    nxt, start = np.zeros((9, 8), np.uint8), np.ones((9, 8), bool)

    def rule(symbol, to, joins):
        nxt[symbol] = to
        for state, after in joins.items():
            nxt[symbol, state], start[symbol, state] = after, False

    rule(LETTER, LETTERS, {LETTERS: LETTERS, PREFIX: LETTERS, ONE_LEFT: FREE, TWO_LEFT: ONE_LEFT})
    rule(NUMBER, NUMBERS, {NUMBERS: NUMBERS, PREFIX: NUMBERS})
    rule(OTHER, OTHERS, {OTHERS: OTHERS, PREFIX: OTHERS})
    rule(SHORT, ONE_LEFT, {OTHERS: OTHERS, PREFIX: OTHERS})
    rule(LONG, TWO_LEFT, {OTHERS: OTHERS, PREFIX: OTHERS})
    rule(MIDDLE, SPACES, {SPACES: SPACES})
    rule(BLANK, PREFIX, {})
    rule(LAST, FREE, {})
    rule(BREAK, FREE, {})
    return nxt, start


class Scan:
    """Positions where matches start, by a prefix scan over numbered transition functions."""

    def __init__(self, runs: tuple | None = None):
        first, kind = runs or class_runs()
        self.kind = np.repeat(np.array(kind, np.uint8), np.diff([*first, END_OF_TEXT + 1]))
        nxt, self.start = _transitions()
        functions = [tuple(range(8)), *(tuple(map(int, row)) for row in nxt)]  # 0: leaves every state
        functions = list(dict.fromkeys(functions))
        number = {f: i for i, f in enumerate(functions)}
        self.symbol = np.array([number[tuple(map(int, row))] for row in nxt], np.uint8)
        generators = [functions[i] for i in self.symbol]
        for f in functions:  # closes the set under composition
            for g in generators:
                made = tuple(g[s] for s in f)
                if made not in number:
                    number[made] = len(functions)
                    functions.append(made)
        table = np.array(functions, np.uint8)
        size = len(functions)
        if size > 256:
            raise ValueError("too many transition functions")
        then = np.zeros((256, 256), np.uint8)
        for i, f in enumerate(functions):
            made = table[:, list(f)]  # row g: g after f
            then[i, :size] = [number[tuple(map(int, row))] for row in made]
        self.then, self.state = then.ravel(), table

    def compose(self, f: np.ndarray, g: np.ndarray) -> np.ndarray:
        return self.then[(f.astype(np.uint16) << 8) | g]

    def prefixes(self, f: np.ndarray) -> np.ndarray:
        """f[0], f[0] then f[1], ... as numbers: blocks side by side, then the blocks' totals."""
        n = len(f)
        if n <= BLOCK:
            out = f.copy()
            for i in range(1, n):
                out[i] = self.then[(int(out[i - 1]) << 8) | int(f[i])]
            return out
        columns = -(-n // BLOCK)
        grid = np.zeros(columns * BLOCK, np.uint8)
        grid[:n] = f
        grid = np.ascontiguousarray(grid.reshape(columns, BLOCK).T)
        for i in range(1, BLOCK):
            grid[i] = self.compose(grid[i - 1], grid[i])
        before = np.zeros(columns, np.uint8)
        before[1:] = self.prefixes(grid[-1])[:-1]
        return self.compose(np.broadcast_to(before, grid.shape), grid).T.ravel()[:n]

    def symbols(self, points: np.ndarray) -> np.ndarray:
        """Symbols of all but the last two code points, which are only looked at."""
        kind = self.kind[points]
        out, after = kind[:-2].copy(), kind[1:-1]
        space = out == LAST
        out[space & ((after == LAST) | (after == BREAK))] = MIDDLE
        out[(points[:-2] == 0x20) & (out == LAST)] = BLANK
        quote = np.flatnonzero(points[:-2] == 0x27)
        if len(quote):
            a, b = points[quote + 1], points[quote + 2]
            out[quote[np.isin(a, [ord(c) for c in "stmd"])]] = SHORT
            pair = np.zeros(len(quote), bool)
            for c, d in ("re", "ve", "ll"):
                pair |= (a == ord(c)) & (b == ord(d))
            out[quote[pair]] = LONG
        return out

    def starts(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Byte offsets in the joined UTF-8 of all starts, and which of them end a text."""
        at, ends, state, base = [], [], FREE, 0
        for points in windows(texts):
            symbol = self.symbols(points)
            core = points[:-2]
            f = self.prefixes(self.symbol[symbol])
            after = self.state[f, state]
            before = np.concatenate([[state], after[:-1]])
            size = 1 + (core >= 0x80).astype(np.int64) + (core >= 0x800) + (core >= 0x10000)
            size[core == END_OF_TEXT] = 0
            offset = base + np.cumsum(size) - size
            found = np.flatnonzero(self.start[symbol, before])
            at.append(offset[found])
            ends.append(core[found] == END_OF_TEXT)
            state, base = int(after[-1]), int(offset[-1] + size[-1])
        if not at:
            return np.zeros(0, np.int64), np.zeros(0, bool)
        return np.concatenate(at), np.concatenate(ends)


def windows(texts: list[str]):
    """Code points of the texts, END_OF_TEXT after each, in windows that overlap by two."""
    mark, held, size = np.array([END_OF_TEXT], np.uint32), [], 0
    for text in texts:
        for i in range(0, len(text) + 1, WINDOW):
            part = text[i:i + WINDOW]
            held.append(np.frombuffer(part.encode("utf-32-le", "surrogatepass"), np.uint32))
            size += len(part)
            if i + WINDOW > len(text):
                held.append(mark)
                size += 1
            if size >= WINDOW + 2:
                joined = np.concatenate(held)
                yield joined
                held, size = [joined[-2:]], 2
    if size > 0 and texts:
        yield np.concatenate([*held, mark, mark])


class Merges(dict):
    """Match -> its ids as int32 bytes; ranks decide which neighbours are joined first."""

    def __init__(self, ranks: dict[bytes, int]):
        super().__init__()
        self.ranks, self.held = ranks, 0
        self.none = max(ranks.values()) + 1  # no id; as a rank: never joined
        self.byte = np.array([ranks[bytes([i])] for i in range(256)], np.int64)
        pairs = {}
        for token, rank in ranks.items():
            for i in range(1, len(token)):
                left, right = ranks.get(token[:i]), ranks.get(token[i:])
                if left is not None and right is not None:
                    pairs[left * (self.none + 1) + right] = rank
        self.pair = np.array(sorted(pairs), np.int64)
        self.joined = np.array([pairs[k] for k in self.pair.tolist()], np.int64)

    def add(self, matches: set[bytes]) -> None:
        """Ids of all matches not kept yet: short ones together, long ones one by one."""
        short = []
        for m in matches:
            if m in self:
                continue
            self.held += len(m)
            if m in self.ranks:
                self[m] = np.int32(self.ranks[m]).tobytes()
            elif len(m) <= TOGETHER_BYTES:
                short.append(m)
            else:
                self[m] = np.array(self._long(m), np.int32).tobytes()
        short.sort(key=len)
        for i in range(0, len(short), TOGETHER):
            part = short[i:i + TOGETHER]
            self.update(zip(part, self._together(part)))

    def rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        key = left * (self.none + 1) + right
        at = np.minimum(np.searchsorted(self.pair, key), len(self.pair) - 1)
        return np.where(self.pair[at] == key, self.joined[at], self.none)

    def _together(self, matches: list[bytes]) -> list[bytes]:
        """Each step joins, in every match, the pair of least rank (the leftmost of equals)."""
        n, width = len(matches), len(matches[-1])
        raw = np.frombuffer(b"".join([m.ljust(width, b"\0") for m in matches]), np.uint8).reshape(n, width)
        length = np.array([len(m) for m in matches])
        columns = np.arange(width)
        ids = np.where(columns < length[:, None], self.byte[raw], self.none)
        ranks = self.rank(ids[:, :-1], ids[:, 1:])
        done, rows = np.full((n, width), self.none, np.int64), np.arange(n)
        while len(rows):
            at = ranks.argmin(1)
            here = np.arange(len(rows))
            least = ranks[here, at]
            over = least == self.none
            if over.any():
                done[rows[over]] = ids[over]
                rows, ids, ranks, at, least = rows[~over], ids[~over], ranks[~over], at[~over], least[~over]
                here = np.arange(len(rows))
                if not len(rows):
                    break
            ids[here, at] = least
            moved = np.minimum(columns + (columns > at[:, None]), width - 1)
            ids = np.take_along_axis(ids, moved, 1)
            ids[:, -1] = self.none
            moved = np.minimum(columns[:-1] + (columns[:-1] > at[:, None]), width - 2)
            ranks = np.take_along_axis(ranks, moved, 1)
            ranks[:, -1] = self.none
            ranks[here, np.minimum(at, width - 2)] = self.rank(least, ids[here, np.minimum(at + 1, width - 1)])
            left = at > 0
            ranks[here[left], at[left] - 1] = self.rank(ids[here[left], at[left] - 1], least[left])
        real = done != self.none
        flat = done[real].astype(np.int32).tobytes()
        ends = np.concatenate([[0], np.cumsum(4 * real.sum(1))]).tolist()
        return [flat[a:b] for a, b in zip(ends, ends[1:])]

    def _long(self, match: bytes) -> list[int]:
        """The same order (least rank, then leftmost) from a heap; an entry whose pair has
        changed since is passed over."""
        ranks, n = self.ranks, len(match)
        size, before = [1] * n, list(range(-1, n - 1))

        def rank(i: int) -> int | None:
            j = i + size[i]
            return ranks.get(match[i:j + size[j]]) if j < n else None

        heap = [(r << 32) | i for i in range(n - 1) if (r := rank(i)) is not None]
        heapq.heapify(heap)
        while heap:
            entry = heapq.heappop(heap)
            i = entry & 0xFFFFFFFF
            if not size[i] or rank(i) != entry >> 32:
                continue
            j = i + size[i]
            size[i], size[j] = size[i] + size[j], 0
            k = i + size[i]
            if k < n:
                before[k] = i
            for p in (before[i], i):
                if p >= 0 and (r := rank(p)) is not None:
                    heapq.heappush(heap, (r << 32) | p)
        out, i = [], 0
        while i < n:
            out.append(ranks[match[i:i + size[i]]])
            i += size[i]
        return out


class Codec:
    """Encoder and decoder of one rank file; built once a task."""

    def __init__(self, path: str | None = None, runs: tuple | None = None):
        with open(path or public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), "rb") as f:
            ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}
        self.merges, self.scan = Merges(ranks), Scan(runs)
        raw: list[bytes] = [b""] * (max(ranks.values()) + 1)
        for token, rank in ranks.items():
            raw[rank] = token
        self.raw = np.frombuffer(b"".join(raw), np.uint8)
        self.size = np.array([len(r) for r in raw], np.int64)
        self.first = np.cumsum(self.size) - self.size

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(ids of all texts, byte offset of each in its own text, ids per text)."""
        at, ends = self.scan.starts(texts)
        raw = b"".join([t.encode("utf-8", "surrogatepass") for t in texts])
        bound = np.append(at, len(raw))
        ids, counts = [], np.zeros(len(at), np.int64)
        for i in range(0, len(at), SLICE):
            edge = bound[i:i + SLICE + 1].tolist()
            matches = [raw[a:b] for a, b in zip(edge, edge[1:])]  # empty where a text ends
            if self.merges.held > CACHED_BYTES:
                self.merges.clear()
                self.merges.held = 0
            self.merges.add(set(matches) - {b""})
            self.merges[b""] = b""
            made = list(map(self.merges.__getitem__, matches))
            counts[i:i + len(made)] = np.fromiter(map(len, made), np.int64, len(made)) // 4
            ids.append(np.frombuffer(b"".join(made), np.int32))
        flat = np.concatenate(ids) if ids else np.zeros(0, np.int32)
        total = np.cumsum(counts)[ends]
        per_text = np.diff(total, prepend=0)
        size = self.size[flat]
        text_start = np.concatenate([[0], at[ends]])[:-1]
        return flat, np.cumsum(size) - size - np.repeat(text_start, per_text), per_text

    def decode(self, ids: np.ndarray, counts: np.ndarray, offsets: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
        """(bytes of all texts, bytes per text). Every id's bytes go to its offset, or behind
        those of the id before where no offsets were kept."""
        size = self.size[ids]
        total = np.concatenate([[0], np.cumsum(size)])
        edge = total[np.concatenate([[0], np.cumsum(counts)])]
        to = total[:-1] if offsets is None else np.repeat(edge[:-1], counts) + offsets
        out = np.zeros(total[-1], np.uint8)
        for i in range(0, len(ids), SLICE):
            n, t, f = size[i:i + SLICE], to[i:i + SLICE], self.first[ids[i:i + SLICE]]
            step = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
            out[np.repeat(t, n) + step] = self.raw[np.repeat(f, n) + step]
        return out, np.diff(edge)


def _list(values: np.ndarray, counts: np.ndarray, none: np.ndarray) -> pa.Array:
    ends = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(values.astype(np.int32)), mask=pa.array(none))


def _fields(df: DataFrame) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields)


def encode(df: DataFrame, text_col: str = "text", ids_col: str = "ids", offsets_col: str = "offsets",
           ranks_path: str | None = None) -> DataFrame:
    """``df`` with ids (array<int>) and the byte offset of each id in the text (array<int>)."""
    if public_tokenizers.PATTERN != PATTERN:
        raise ValueError("the automaton stands for another splitting pattern")
    runs = class_runs()

    def run(it):
        codec = Codec(ranks_path, runs)
        for b in batches(it, 1 << 20):
            texts = b.column(text_col).to_pylist()
            none = np.array([t is None for t in texts])
            ids, offsets, counts = codec.encode([t or "" for t in texts])
            yield pa.RecordBatch.from_arrays([*b.columns, _list(ids, counts, none), _list(offsets, counts, none)],
                                             names=[*b.schema.names, ids_col, offsets_col])

    return df.mapInArrow(run, f"{_fields(df)}, `{ids_col}` array<int>, `{offsets_col}` array<int>")


def decode(df: DataFrame, ids_col: str = "ids", offsets_col: str | None = None, out_col: str = "decoded",
           ranks_path: str | None = None) -> DataFrame:
    """``df`` with the bytes of its ids (binary), placed at the kept offsets where named."""
    runs = class_runs()

    def run(it):
        codec = Codec(ranks_path, runs)
        for b in batches(it, 4 << 20):
            lists = b.column(ids_col)
            none = np.array(lists.is_null())
            counts = np.where(none, 0, np.array(lists.value_lengths().fill_null(0))).astype(np.int64)
            kept = None if offsets_col is None else np.array(b.column(offsets_col).flatten())
            out, sizes = codec.decode(np.array(lists.flatten()), counts, kept)
            ends = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
            mask = np.packbits(~none, bitorder="little").tobytes()
            made = pa.Array.from_buffers(pa.binary(), len(none), [pa.py_buffer(mask), pa.py_buffer(ends), pa.py_buffer(out)])
            yield pa.RecordBatch.from_arrays([*b.columns, made], names=[*b.schema.names, out_col])

    return df.mapInArrow(run, f"{_fields(df)}, `{out_col}` binary")


def digests(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", ranks_path: str | None = None) -> DataFrame:
    """One row per document: doc_id, n_tokens, ids_sha256 (decimal ids joined by commas),
    decoded_sha256 (the bytes that the ids decode to). Null text counts as empty."""
    picked = docs.select(F.col(id_col).alias("doc_id"), whole_text(text_col).alias("text"))
    coded = encode(picked, ranks_path=ranks_path).drop("text")
    coded = decode(coded, offsets_col="offsets", ranks_path=ranks_path)
    return coded.select("doc_id", F.size("ids").cast("long").alias("n_tokens"),
                        F.sha2(F.concat_ws(",", F.col("ids").cast("array<string>")), 256).alias("ids_sha256"),
                        F.sha2("decoded", 256).alias("decoded_sha256"))
