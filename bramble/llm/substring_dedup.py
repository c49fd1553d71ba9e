"""Substring deduplication: words of 50-word windows that an earlier document has too.

A window is represented by the least of its 25-word grams (by hash, leftmost on ties): equal
windows have equal representatives at the same place, so a window's count is at most its
gram's count. Neighbouring windows mostly share a representative; such a run of up to 26
windows is one occurrence, about one per 13 words.

1. Count-min sketch: every task counts its grams in two rows of counters (saturating at 2)
   and emits the counters it touched; owner tasks merge the partial sketches per block of
   counters. What is left is one bit per counter: counted at least twice. The sketch has
   about five counters per gram of the input at every size. Up to 2^``max_log_width`` counters a
   row (the bound of the broadcast) its bits go to all tasks; a wider one stays with the owner
   tasks of its blocks, the grams meet it there, and occurrences find their grams by a join.
2. A second pass writes only the occurrences that both rows estimate as repeated, with a hash
   of their whole stretch of words and of each window.
3. Exact grouping. Occurrences with the same stretch form a class (copies collapse here,
   before the shuffle). Where a gram has one class, its smallest document owns all windows;
   where it has several, the windows of the classes, not of the documents, are grouped.
4. Every occurrence takes from its class which of its windows a smaller document owns, and
   every text drops the words that those windows cover.

Windows are compared by the hash of their gram and, among windows with the same gram, by a
hash of the whole window to another base over other numbers of the words: different windows
with the same gram agree with odds of about 2^-64, others with about 2^-128.

Null text counts as empty; texts under 50 words lose nothing; rows with the same doc_id do
not remove words of each other; a null doc_id counts as larger than any other; an empty
table gives an empty result; other columns are left alone.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from bramble.llm.shared import batches, record_batch, utf8, whole_text, write_shared
from bramble.llm.textbytes import Words, mix

WINDOW = 50
GRAM = 25
MEMORY = 500_000  # stretches that a task remembers to have listed
BLOCK_BITS = 16  # counters of a block of the sketch
_ROWS = (np.uint64(0x5851F42D4C957F2D), np.uint64(0x14057B7EF767814F))
_BLOCK = np.uint64(0x9FB21C651E98DF25)
_LOW = np.uint64(0xFFFFFFFF)


def sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """min(values[i:i + width]) for every i, by doubling."""
    out, have = values, 1
    while have < width:
        step = min(have, width - have)
        out = np.minimum(out[:-step], out[step:])
        have += step
    return out


class Occurrences:
    """The runs of windows with one representative, in a batch of texts."""

    def __init__(self, words: Words, texts: list[bytes], window: int = WINDOW, gram: int = GRAM):
        self.docs, numbers, again, _ = words.read(texts)
        m = len(numbers)
        empty = np.zeros(0, np.int64)
        self.doc, self.first, self.n, self.place = empty, empty, empty, empty
        self.key = self.stretch = np.zeros(0, np.uint64)
        self.window_hashes = np.zeros(0, np.uint64)
        if m < window:
            return
        prefix = words.of_words.prefix(numbers)
        at = np.arange(m - gram + 1)
        grams = words.of_words.spans(prefix, at, at + gram)
        least = sliding_min((grams & ~_LOW) | at.astype(np.uint64), window - gram + 1)
        sizes = np.diff(self.docs)
        ends = np.repeat(self.docs[1:], sizes)
        start = np.flatnonzero(np.arange(len(least)) + window <= ends[:len(least)])
        if not len(start):
            return
        gram_at = (least[start] & _LOW).astype(np.int64)
        new = np.concatenate([[True], (gram_at[1:] != gram_at[:-1]) | (start[1:] != start[:-1] + 1)])
        runs = np.flatnonzero(new)
        first, self.n = start[runs], np.diff(np.concatenate([runs, [len(start)]]))
        self.key = grams[gram_at[runs]]
        self.place = gram_at[runs] - first
        whole = words.of_words_again
        prefix = whole.prefix(again)
        self.stretch = mix(whole.spans(prefix, first, first + self.n + window - 1)
                           ^ mix((self.place.astype(np.uint64) << np.uint64(32)) | self.n.astype(np.uint64)))
        self.window_hashes = whole.spans(prefix, start, start + window)
        self.offsets = np.concatenate([[0], np.cumsum(self.n)])
        self.doc = np.searchsorted(self.docs, first, "right") - 1
        self.first = first - self.docs[self.doc]


def cells(keys: np.ndarray, log_width: int) -> list[np.ndarray]:
    """The counter of each key in each row of the sketch."""
    return [mix(keys ^ seed) >> np.uint64(64 - log_width) for seed in _ROWS]


def _emit(keys: list[np.ndarray], log_width: int) -> pa.RecordBatch:
    """The counters that some keys touch: per block those touched once and more often."""
    blocks = 1 << max(0, log_width - BLOCK_BITS)
    per_block = min(BLOCK_BITS, log_width)
    block, once, more = [], [], []
    for row, cell in enumerate(cells(np.concatenate(keys), log_width)):
        cell, count = np.unique(cell, return_counts=True)
        b = (cell >> np.uint64(per_block)).astype(np.int64)
        low = (cell & np.uint64((1 << per_block) - 1)).astype(np.uint16)
        cut = np.flatnonzero(np.concatenate([[True], b[1:] != b[:-1], [True]]))
        for i, j in zip(cut[:-1], cut[1:]):
            block.append(row * blocks + int(b[i]))
            once.append(low[i:j][count[i:j] == 1].tobytes())
            more.append(low[i:j][count[i:j] > 1].tobytes())
    return record_batch(pa.schema([("block", pa.int32()), ("once", pa.binary()), ("more", pa.binary())]), [block, once, more])


def _merged(parts: DataFrame, log_width: int, least: int) -> np.ndarray:
    """Bits (row, counter) of the merged partial sketches: counted ``least`` times or more."""
    per_block = min(BLOCK_BITS, log_width)
    schema = pa.schema([("block", pa.int32()), ("bits", pa.binary())])

    def merge(it):
        current, counters = None, None
        out = lambda: record_batch(schema, [[current], [np.packbits(counters >= least, bitorder="little").tobytes()]])
        for b in it:
            for block, once, more in zip(*(b.column(i).to_pylist() for i in range(3))):
                if block != current:
                    if current is not None:
                        yield out()
                    current, counters = block, np.zeros(1 << per_block, np.uint8)
                at = np.frombuffer(once, np.uint16)  # distinct counters within a row
                counters[at] = np.minimum(counters[at] + 1, 2)
                counters[np.frombuffer(more, np.uint16)] = 2
        if current is not None:
            yield out()

    parts = parts.repartition("block").sortWithinPartitions("block").mapInArrow(merge, "block int, bits binary")
    bits = np.zeros(len(_ROWS) << log_width >> 3, np.uint8)
    size = 1 << per_block >> 3
    for r in parts.toLocalIterator(prefetchPartitions=False) if log_width > 28 else parts.collect():
        bits[r.block * size:(r.block + 1) * size] = np.frombuffer(bytes(r.bits), np.uint8)
    return bits


def _emitted(batches_of_keys, log_width: int, flush: int = 1 << 20):
    keys, held = [], 0
    for k in batches_of_keys:
        keys.append(k)
        held += len(k)
        if held >= flush:
            yield _emit(keys, log_width)
            keys, held = [], 0
    if held:
        yield _emit(keys, log_width)


_PARTS = "block int, once binary, more binary"


def sketch(docs: DataFrame, log_width: int, window: int, gram: int) -> np.ndarray:
    """Bits of the count-min sketch of all occurrences' grams: counted at least twice."""
    def count(it):
        words = Words()
        grams = (Occurrences(words, [utf8(t) for t in b.column(0).to_pylist()], window, gram).key for b in batches(it))
        yield from _emitted(grams, log_width)

    return _merged(docs.select("text").mapInArrow(count, _PARTS), log_width, 2)


def key_filter(rows: DataFrame, log_width: int) -> np.ndarray:
    """Bits of the column ``key``, one for each counter that some key has."""
    def count(it):
        yield from _emitted((b.column(0).to_numpy().view(np.uint64) for b in it if b.num_rows), log_width)

    return _merged(rows.select("key").mapInArrow(count, _PARTS), log_width, 1)


def repeated(bits: np.ndarray, keys: np.ndarray, log_width: int) -> np.ndarray:
    """Which keys every row of the sketch estimates at two or more."""
    ok = np.ones(len(keys), bool)
    for row, cell in enumerate(cells(keys, log_width)):
        cell = cell + np.uint64(row << log_width)
        ok &= (bits[cell >> np.uint64(3)] >> (cell & np.uint64(7)).astype(np.uint8) & 1).astype(bool)
    return ok


def blocked(keys: np.ndarray, log_width: int, block_bits: int) -> tuple[np.ndarray, list[np.ndarray]]:
    """Of a sketch in blocks: the block of each key, and its counter there in each row."""
    block = (mix(keys ^ _BLOCK) >> np.uint64(64 - (log_width - block_bits))).astype(np.int64) if log_width > block_bits \
        else np.zeros(len(keys), np.int64)
    return block, cells(keys, block_bits)


def repeated_keys(docs: DataFrame, log_width: int, window: int, gram: int) -> DataFrame:
    """The distinct grams (``key``) that a sketch of any width estimates at two or more. A gram
    has its counters of both rows in one block; an owner task holds one block at a time
    (2^24 counters a row at most), its different grams, and nothing of the other blocks."""
    block_bits = min(log_width, max(BLOCK_BITS, min(24, log_width - 14)))
    spec = pa.schema([("block", pa.int64()), ("keys", pa.binary())])

    def deal(it):
        words = Words()

        def out(keys):
            keys = np.concatenate(keys)
            block = blocked(keys, log_width, block_bits)[0]
            order = np.lexsort((keys, block))
            keys, block = keys[order], block[order]
            # a gram that a flush has more than twice need not be told of thrice
            again = np.concatenate([[False, False], (keys[2:] == keys[:-2]) & (block[2:] == block[:-2])])[:len(keys)]
            keys, block = keys[~again], block[~again]
            cut = np.flatnonzero(np.concatenate([[True], block[1:] != block[:-1], [True]]))
            return record_batch(spec, [block[cut[:-1]], [keys[i:j].tobytes() for i, j in zip(cut[:-1], cut[1:])]])

        held, n = [], 0
        for b in batches(it):
            k = Occurrences(words, [utf8(t) for t in b.column(0).to_pylist()], window, gram).key
            held.append(k)
            n += len(k)
            if n >= 1 << 20:
                yield out(held)
                held, n = [], 0
        if n:
            yield out(held)

    def meet(it):
        current, counters, met, waiting = None, None, np.zeros(0, np.uint64), []

        def passed():
            keys = np.unique(np.concatenate([met, *waiting]))
            ok = np.ones(len(keys), bool)
            for row, cell in enumerate(cells(keys, block_bits)):
                ok &= counters[row][cell] >= 2
            return pa.RecordBatch.from_arrays([pa.array(keys[ok].view(np.int64))], names=["key"])

        for b in it:
            for block, raw in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                if block != current:
                    if current is not None:
                        yield passed()
                    current, met, waiting = block, np.zeros(0, np.uint64), []
                    counters = [np.zeros(1 << block_bits, np.uint8) for _ in _ROWS]
                keys = np.frombuffer(raw, np.uint64)
                for row, cell in enumerate(cells(keys, block_bits)):
                    cell, n = np.unique(cell, return_counts=True)
                    counters[row][cell] = np.minimum(counters[row][cell] + np.minimum(n, 2), 2)
                waiting.append(keys)
                if sum(map(len, waiting)) > max(1 << 16, len(met)):
                    met, waiting = np.unique(np.concatenate([met, *waiting])), []
        if current is not None:
            yield passed()

    parts = docs.select("text").mapInArrow(deal, "block bigint, keys binary")
    return write_shared(parts.repartition("block").sortWithinPartitions("block").mapInArrow(meet, "key bigint"), "substring-grams")


def _picked(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.xxhash64(whole_text(text_col)).alias("sig"),
                       whole_text(text_col).alias("text"))


def candidates(docs: DataFrame, window: int, gram: int, max_log_width: int,
               log_width: int | None = None) -> tuple[DataFrame, int | None]:
    """(occurrences, log of the sketch's width, None where it is not broadcast). Occurrences of grams that the sketch estimates as repeated: doc_id, sig, key, stretch,
    first (word of the first window), n (windows), windows (their hashes)."""
    if not 0 < window - gram < 63:
        raise ValueError("the gram must be shorter than the window, by less than 63 words")
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    log_width = log_width or max(BLOCK_BITS, (size // 16).bit_length())
    wide = log_width > max_log_width
    grams = repeated_keys(docs, log_width, window, gram) if wide else None
    shared = None if wide else docs.sparkSession.sparkContext.broadcast(sketch(docs, log_width, window, gram))  # 2^(log_width - 2) bytes

    def pick(it):
        words, bits, listed = Words(), None if shared is None else shared.value, set()
        for b in batches(it):
            o = Occurrences(words, [utf8(t) for t in b.column(2).to_pylist()], window, gram)
            hit = np.arange(len(o.key)) if bits is None else np.flatnonzero(repeated(bits, o.key, log_width))
            if len(hit):
                doc = pa.array(o.doc[hit])
                names = ["doc_id", "sig", "key", "stretch", "first", "n", "windows"]
                plain = [b.column(0).take(doc), b.column(1).take(doc), pa.array(o.key[hit].view(np.int64)),
                         pa.array(o.stretch[hit].view(np.int64)), pa.array(o.first[hit].astype(np.int32)),
                         pa.array(o.n[hit].astype(np.int32))]
                # a task lists the windows of a stretch once; copies leave them out
                new = np.array([s not in listed and not listed.add(s) for s in o.stretch[hit].tolist()])
                if len(listed) > MEMORY:
                    listed.clear()
                n = np.where(new, o.n[hit], 0)
                at = np.repeat(o.offsets[hit] - np.concatenate([[0], np.cumsum(n)[:-1]]), n) + np.arange(n.sum())
                ends = pa.array(np.concatenate([[0], np.cumsum(n)]), pa.int32())
                lists = pa.ListArray.from_arrays(ends, pa.array(o.window_hashes[at].view(np.int64)), mask=pa.array(~new))
                yield pa.RecordBatch.from_arrays([*plain, lists], names=names)

    found = docs.mapInArrow(pick, "doc_id bigint, sig bigint, key bigint, stretch bigint, first int, n int, windows array<bigint>")
    if wide:
        found = found.join(grams, "key", "left_semi")
    return write_shared(found.withColumn("rank", _rank()), "substring-candidates"), None if wide else log_width


def _rank() -> Column:
    return F.coalesce("doc_id", F.lit(2 ** 63 - 1))


def removals(found: DataFrame, log_width: int | None) -> DataFrame:
    """(doc_id, sig, cuts): per document an array of (first, mask), bit i of the mask set
    where the window that starts at word first + i is removed."""
    classes = write_shared(found.groupBy("key", "stretch").agg(F.min("rank").alias("owner"), F.max("rank").alias("latest")),
                           "substring-classes")
    shared = (classes.groupBy("key").agg(F.count("*").alias("classes"), F.min("owner").alias("a"), F.max("latest").alias("b"))
              .where("a < b").select("key", "classes"))  # in one document only: nothing to remove
    alive = write_shared(classes.join(shared, "key").select("key", "stretch", "owner", "classes"), "substring-shared")
    alone = alive.where("classes = 1").select("key", "stretch", "owner", F.lit(None).cast("array<bigint>").alias("owners"))
    # only grams with several classes need their windows, once per class; a filter of their
    # keys (as large as the sketch, where that is broadcast) spares the others the shuffle
    many = alive.where("classes > 1").select("key", "stretch", "owner")
    wanted = None if log_width is None else found.sparkSession.sparkContext.broadcast(key_filter(many, log_width))

    def pick(it):
        bits = wanted.value
        for b in it:
            hit = np.flatnonzero(repeated(bits, b.column(0).to_numpy().view(np.uint64), log_width))
            if len(hit):
                yield b.take(pa.array(hit))

    listed = found.where("windows is not null").select("key", "stretch", "windows")
    if wanted is not None:
        listed = listed.mapInArrow(pick, "key bigint, stretch bigint, windows array<bigint>")
    listed = listed.groupBy("key", "stretch").agg(F.first("windows").alias("windows"))
    windows = listed.join(many, ["key", "stretch"]).select("key", "stretch", "owner", F.posexplode("windows").alias("i", "window"))
    first = windows.groupBy("key", "window").agg(F.min("owner").alias("owner"))
    several = (windows.drop("owner").join(first, ["key", "window"]).groupBy("key", "stretch")
               .agg(F.transform(F.sort_array(F.collect_list(F.struct("i", "owner"))), lambda x: x["owner"]).alias("owners"))
               .select("key", "stretch", F.lit(None).cast("bigint").alias("owner"), "owners"))

    def bit(i: Column | str) -> Column:
        return F.call_function("shiftleft", F.lit(1).cast("bigint"), F.col(i) if isinstance(i, str) else i)

    none = F.lit(0).cast("bigint")
    each = F.aggregate(F.transform("owners", lambda o, i: F.when(o < F.col("rank"), bit(i)).otherwise(none)),
                       none, lambda a, x: a.bitwiseOR(x))
    mask = F.when(F.col("owner").isNull(), each).when(F.col("owner") < F.col("rank"), bit("n") - 1).otherwise(none)
    cut = (found.select("doc_id", "sig", "key", "stretch", "first", "n", "rank").join(alone.union(several), ["key", "stretch"])
           .select("doc_id", "sig", "first", mask.alias("mask")).where("mask <> 0"))
    return cut.groupBy("doc_id", "sig").agg(F.collect_set(F.struct("first", "mask")).alias("cuts"))


def covered(cuts, n_words: int, window: int) -> np.ndarray:
    """Which words the removed windows cover."""
    edge = np.zeros(n_words + 1, np.int64)
    for c in cuts or ():
        mask, at = c["mask"], c["first"]
        starts = [at + i for i in range(mask.bit_length()) if mask >> i & 1]
        for s in starts:
            edge[s] += 1
            edge[s + window] -= 1
    return np.cumsum(edge[:-1]) > 0


def _with_cuts(docs: DataFrame, id_col: str, text_col: str, window: int, gram: int, max_log_width: int,
               log_width: int | None = None) -> DataFrame:
    picked = _picked(docs, id_col, text_col)
    cuts = write_shared(removals(*candidates(picked, window, gram, max_log_width, log_width)), "substring-cuts").select(
        F.col("doc_id").alias("_cut_id"), F.col("sig").alias("_cut_sig"), F.col("cuts").alias("_cuts"))
    return docs.join(cuts, F.xxhash64(whole_text(text_col)).eqNullSafe(F.col("_cut_sig"))
                     & F.col(id_col).cast("bigint").eqNullSafe(F.col("_cut_id")), "left").drop("_cut_id", "_cut_sig")


def substring_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW,
                    gram: int = GRAM, max_log_width: int = 30, log_width: int | None = None) -> DataFrame:
    """One row per document: doc_id, n_words, n_removed, kept_sha256. ``log_width`` sets the
    sketch's width, which else follows the input's size."""
    rows = _with_cuts(docs.select(id_col, text_col), id_col, text_col, window, gram, max_log_width, log_width)
    id_type = docs.schema[id_col].dataType.simpleString()
    schema = pa.schema([("n_words", pa.int64()), ("n_removed", pa.int64()), ("kept_sha256", pa.string())])

    def digest(it):
        for b in batches(it):
            out = []
            for text, cuts in zip(b.column(1).to_pylist(), b.column(2).to_pylist()):
                words, gone = utf8(text).split(), 0
                n = len(words)
                if cuts:
                    cover = covered(cuts, n, window)
                    gone = int(cover.sum())
                    words = [w for w, c in zip(words, cover.tolist()) if not c]
                out.append((n, gone, hashlib.sha256(b" ".join(words)).hexdigest()))
            yield pa.RecordBatch.from_arrays(
                [b.column(0), *record_batch(schema, list(zip(*out))).columns], names=["doc_id", *schema.names])

    return rows.select(F.col(id_col).alias("doc_id"), whole_text(text_col).alias("text"), "_cuts").mapInArrow(
        digest, f"doc_id {id_type}, n_words bigint, n_removed bigint, kept_sha256 string")


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW,
                   gram: int = GRAM, max_log_width: int = 30) -> DataFrame:
    """``docs`` with the covered words cut from their texts; white space between the words
    that stay is as it was, columns stay as they are (n_chars follows where there is one)."""
    rows = _with_cuts(docs, id_col, text_col, window, gram, max_log_width)

    def cut(it):
        words = Words()
        for b in batches(it):
            texts = b.column(text_col).to_pylist()
            all_cuts = b.column("_cuts").to_pylist()
            for k, cuts in enumerate(all_cuts):
                if cuts:
                    raw = utf8(texts[k])
                    *_, start = words.read([raw])
                    gone = covered(cuts, len(start), window)
                    edge = np.flatnonzero(np.diff(np.concatenate([[False], gone, [False]])))
                    stop = np.concatenate([start, [len(raw)]])
                    parts, at = [], 0
                    for i, j in zip(edge[0::2], edge[1::2]):
                        parts.append(raw[at:start[i]])
                        at = stop[j]
                    texts[k] = b"".join([*parts, raw[at:]]).decode("utf-8", "surrogatepass").rstrip(" ")
            columns = [pa.array(texts, b.schema.field(n).type) if n == text_col else b.column(n) for n in b.schema.names if n != "_cuts"]
            yield pa.RecordBatch.from_arrays(columns, names=[n for n in b.schema.names if n != "_cuts"])

    out = rows.select(*docs.columns, "_cuts").mapInArrow(cut, docs.schema)
    return out.withColumn("n_chars", F.char_length(whole_text(text_col)).cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else out


ORACLE = r"""
WITH split AS (
  SELECT doc_id, [x FOR x IN regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+') IF x <> ''] AS ws
  FROM documents
), windows AS (
  SELECT doc_id, unnest(range(1, len(ws) - 48)) AS i, ws FROM split WHERE len(ws) >= 50
), keyed AS (
  SELECT doc_id, i, array_to_string(ws[i:i + 49], ' ') AS seq FROM windows
), owners AS (
  SELECT seq, min(doc_id) AS first_doc FROM keyed GROUP BY seq
), gone AS (
  SELECT DISTINCT k.doc_id, k.i + o.j AS p
  FROM keyed k JOIN owners w USING (seq) CROSS JOIN range(0, 50) o(j)
  WHERE w.first_doc < k.doc_id
), cut AS (
  SELECT doc_id, list(p) AS ps FROM gone GROUP BY doc_id
), kept AS (
  SELECT s.doc_id, len(s.ws) AS n_words, coalesce(len(c.ps), 0) AS n_removed,
         CASE WHEN c.ps IS NULL THEN s.ws
              ELSE [x[1] FOR x IN list_zip(s.ws, range(1, len(s.ws) + 1)) IF NOT list_contains(c.ps, x[2])] END AS ks
  FROM split s LEFT JOIN cut c USING (doc_id)
)
SELECT doc_id, n_words, n_removed, sha256(coalesce(array_to_string(ks, ' '), '')) AS kept_sha256 FROM kept
"""
