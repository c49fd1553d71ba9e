"""Line deduplication by pairwise alignment of overlapping documents.

Lines (\\n-split, with a word in them) are known by a 128-bit hash. A window is a shortest run of
lines with ``min_words`` words, from a line on or up to a line; every line of a common block
lies in a window inside the block, so documents with a common block share a window. Shared
windows only name the pairs: a rare one (in ``rare_docs`` documents at most) pairs a later
document with every earlier holder, a more frequent one with its earliest holder, the n-th of
a document with the earliest holder of n. Each pair is aligned over the two documents' whole
line lists. Aligned lines that follow each other in both documents form common blocks, and the
later document loses the blocks of ``min_words`` words or more; shorter coincidences stay.
Where a shared window doesn't go, since the alignment with its holder crosses it, its other
earlier holders are tried in rounds, each with some ``GROWTH`` times as many, until it goes or
none is left. So the result is that of aligning all pairs, while the pairs stay near linear
in the lines.

Alignment is a patience diff: equal lines at both ends of a gap (at first, the documents) are
aligned, lines unique in both sides of the gap are anchors, their longest increasing sequence
is kept, and the gaps between are aligned anew. A gap without such lines is aligned by a
longest common subsequence; runs then move beside the next one where equal lines allow it.

Order is by doc_id, null last; rows with equal doc_ids are ordered by their texts' hash, and
rows equal in both are one document. Null text stays null and has no lines; blank lines stay;
an empty table gives an empty result; other columns are left alone.
"""

from __future__ import annotations

from bisect import bisect_left

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from bramble.llm.shared import batches, utf8, whole_text, write_shared

RARE_DOCS = 4
MIN_WORDS = 5
GROWTH = 16
HELD_BITS = 1 << 28


def split_lines(text: bytes) -> list[bytes]:
    return text.split(b"\n")


def ranked(id_col: str, text_col: str) -> list[Column]:
    return [F.coalesce(F.col(id_col).cast("bigint"), F.lit(2 ** 63 - 1)).alias("rank"), F.xxhash64(whole_text(text_col)).alias("sig")]


def line_lists(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(rank, sig, keys, words): one row per document that has lines with a word; keys has
    16 bytes for each of these lines, words their numbers of words (4 bytes each)."""
    picked = docs.select(*ranked(id_col, text_col), whole_text(text_col).alias("text"))

    def run(it):
        for b in batches(it):
            row, keys, words = [], [], []
            for d, text in enumerate(b.column(2).to_pylist()):
                own = [(xxhash.xxh3_128_digest(x), n) for x in split_lines(utf8(text)) if (n := len(x.split()))]
                if own:
                    row.append(d)
                    keys.append(b"".join(k for k, _ in own))
                    words.append(np.array([n for _, n in own], np.int32).tobytes())
            at = pa.array(row, pa.int64())
            yield pa.RecordBatch.from_arrays([b.column(0).take(at), b.column(1).take(at), pa.array(keys, pa.binary()),
                                              pa.array(words, pa.binary())], names=["rank", "sig", "keys", "words"])

    # rows equal in doc_id and text are one document
    return picked.mapInArrow(run, "rank bigint, sig bigint, keys binary, words binary").distinct()


def windows(words: list[int], min_words: int) -> list[tuple[int, int]]:
    """(first line, line after the last) of the shortest runs of lines with enough words that
    start at a line or end at one."""
    out, end, total = set(), 0, 0
    for start, n in enumerate(words):
        while end < len(words) and total < min_words:
            total += words[end]
            end += 1
        if total < min_words:
            break
        out.add((start, end))
        total -= n
    start, total = len(words), 0
    for end in range(len(words), 0, -1):
        while start and total < min_words:
            start -= 1
            total += words[start]
        if total < min_words:
            break
        out.add((start, end))
        total -= words[end - 1]
    return sorted(out)


def window_rows(lists: DataFrame, min_words: int) -> DataFrame:
    """(rank, sig, start, end, key, occurrence): the windows of each document."""
    def run(it):
        for b in batches(it, 1 << 18):
            row, starts, ends, keys, occurrence = [], [], [], [], []
            for d, (k, n) in enumerate(zip(b.column(2).to_pylist(), b.column(3).to_pylist())):
                at: dict[bytes, int] = {}
                for start, end in windows(np.frombuffer(n, np.int32).tolist(), min_words):
                    key = k[16 * start:16 * end] if end == start + 1 else xxhash.xxh3_128_digest(k[16 * start:16 * end])
                    at[key] = at.get(key, 0) + 1
                    row.append(d)
                    starts.append(start)
                    ends.append(end)
                    keys.append(key)
                    occurrence.append(at[key])
            at_row = pa.array(row, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [b.column(0).take(at_row), b.column(1).take(at_row), pa.array(starts, pa.int32()), pa.array(ends, pa.int32()),
                 pa.array(keys, pa.binary()), pa.array(occurrence, pa.int32())],
                names=["rank", "sig", "start", "end", "key", "occurrence"])

    return lists.mapInArrow(run, "rank bigint, sig bigint, start int, end int, key binary, occurrence int")


def follows(o: str = "o.") -> Column:
    return (F.col("rank") > F.col(f"{o}o_rank")) | ((F.col("rank") == F.col(f"{o}o_rank")) & (F.col("sig") > F.col(f"{o}o_sig")))


HOLDER = ["rank as o_rank", "sig as o_sig"]


def shared_windows(lists: DataFrame, min_words: int) -> DataFrame:
    """Windows in several documents, with their number (docs) and the earliest (o)."""
    rows = write_shared(window_rows(lists, min_words), "line-windows")
    held = rows.where("occurrence = 1").groupBy("key").agg(
        F.count("*").alias("docs"), F.min(F.expr("struct(rank as o_rank, sig as o_sig)")).alias("o")).where("docs > 1")
    return write_shared(rows.join(held, "key"), "line-shared")


def first_pairs(known: DataFrame, rare_docs: int) -> DataFrame:
    """(rank, sig, o_rank, o_sig) of a later and an earlier document with a common window."""
    pair = ["rank", "sig", "o_rank", "o_sig"]
    once = known.where("occurrence = 1")
    star = once.where(follows()).select("rank", "sig", "o.*")
    rare = once.where(F.col("docs").between(3, rare_docs))
    others = rare.selectExpr("key", *HOLDER)
    again = known.where("occurrence > 1").drop("o", "docs")
    held = again.groupBy("key", "occurrence").agg(F.min(F.expr("struct(rank as o_rank, sig as o_sig)")).alias("o"))
    return (star.union(rare.drop("o").join(others, "key").where(follows("")).select(*pair))
            .union(again.join(held, ["key", "occurrence"]).where(follows()).select("rank", "sig", "o.*")).distinct())


def last_turn() -> Column:
    return F.floor(F.log("docs") / F.log(F.lit(float(GROWTH)))).cast("int")


def next_pairs(left: DataFrame, known: DataFrame, turn: int) -> DataFrame:
    """Pairs of the windows left with this round's share of their other earlier holders: a
    holder's hash deals it to a round, each with ``GROWTH`` times the holders of the last."""
    tries = left.select("key", "rank", "sig", "docs").distinct()
    last = last_turn()
    zeros = F.length(F.regexp_extract(F.lower(F.hex(F.xxhash64("key", "rank", "sig"))), "(0*)$", 1))
    holders = known.where("occurrence = 1").where(last - F.least(zeros, last) == turn).selectExpr("key", *HOLDER)
    return tries.join(holders, "key").where(follows("")).select("rank", "sig", "o_rank", "o_sig").distinct()


def longest_increasing(values: list[int]) -> list[int]:
    """Indices of a longest strictly increasing subsequence (patience sorting)."""
    tops, piles, before = [], [], []
    for i, v in enumerate(values):
        k = bisect_left(tops, v)
        before.append(piles[k - 1] if k else -1)
        if k == len(tops):
            tops.append(v)
            piles.append(i)
        else:
            tops[k], piles[k] = v, i
    out, i = [], piles[-1] if piles else -1
    while i >= 0:
        out.append(i)
        i = before[i]
    return out[::-1]


def align(matches: list[tuple[int, int, bool]]) -> list[tuple[int, int]]:
    """Patience diff of a pair from its shared lines (pos, o_pos, unique in both): aligned
    (pos, o_pos) in order."""
    matches = sorted(matches)
    unique = [m for m in matches if m[2]]
    anchors = [unique[i] for i in longest_increasing([m[1] for m in unique])]
    rest = [m for m in matches if not m[2]]
    if not rest:
        return [(a, b) for a, b, _ in anchors]
    out, k = [], 0
    edges = [(-1, -1), *[(a, b) for a, b, _ in anchors], (1 << 60, 1 << 60)]
    for (a0, b0), (a1, b1) in zip(edges, edges[1:]):
        gap = []
        while k < len(rest) and rest[k][0] < a1:
            if rest[k][0] > a0 and b0 < rest[k][1] < b1:
                gap.append(rest[k])
            k += 1
        out += [(gap[i][0], gap[i][1]) for i in longest_increasing([g[1] for g in gap])]
        if a1 < 1 << 60:
            out.append((a1, b1))
    return out


def common_blocks(matches: list[tuple[int, int, bool, int]], min_words: int) -> list[int]:
    """Line numbers of the later document that lie in aligned blocks of enough words, from
    matches given one by one."""
    return enough(align([m[:3] for m in matches]), {m[0]: m[3] for m in matches}, min_words)


def enough(pairs: list[tuple[int, int]], words: list[int] | dict[int, int], min_words: int) -> list[int]:
    """Positions in the later document of the aligned blocks of enough words."""
    out, block, total = [], [], 0
    last = None
    for pair in pairs:
        if last is None or pair != (last[0] + 1, last[1] + 1):
            out += block if total >= min_words else []
            block, total = [], 0
        block.append(pair[0])
        total += words[pair[0]]
        last = pair
    return out + (block if total >= min_words else [])


def common_subsequence(a: list, b: list) -> list[tuple[int, int]]:
    """Longest common subsequence, bit-parallel (a row of the table is one integer); long
    inputs are halved as in Hirschberg's algorithm, so that the rows held stay bounded."""
    def rows(x: list, y: list):
        at: dict = {}
        for j, k in enumerate(y):
            at.setdefault(k, []).append(j)
        full = (1 << len(y)) - 1
        v = full
        for k in x:
            mask = bytearray(len(y) // 8 + 1)
            for j in at.get(k, ()):
                mask[j >> 3] |= 1 << (j & 7)
            u = v & int.from_bytes(mask, "little")
            v = ((v + u) | (v - u)) & full
            yield v  # bit j is 0 where the length grows at y[j]

    if not a or not b:
        return []
    if len(a) > 1 and len(a) * len(b) > HELD_BITS:
        half = len(a) // 2
        for top in rows(a[:half], b):
            pass
        for low in rows(a[:half - 1:-1], b[::-1]):
            pass
        above, below = f"{top:0{len(b)}b}"[::-1], f"{low:0{len(b)}b}"
        gain, best, cut = 0, 0, 0
        for j in range(len(b)):
            gain += (above[j] == "0") - (below[j] == "0")
            if gain > best:
                best, cut = gain, j + 1
        return common_subsequence(a[:half], b[:cut]) + [(i + half, j + cut) for i, j in common_subsequence(a[half:], b[cut:])]
    held = list(rows(a, b))
    out, i, j = [], len(a) - 1, len(b) - 1
    while i >= 0 and j >= 0:
        if held[i] >> j & 1:
            j -= 1
        elif i and not held[i - 1] >> j & 1:
            i -= 1
        else:
            out.append((i, j))
            i, j = i - 1, j - 1
    return out[::-1]


def joined_runs(pairs: list[tuple[int, int]], a: list[bytes], b: list[bytes]) -> list[tuple[int, int]]:
    """Aligned pairs, a run moved beside the next one where equal lines allow it."""
    runs: list[list[int]] = []
    for i, j in pairs:
        if runs and (i, j) == (runs[-1][0] + runs[-1][2], runs[-1][1] + runs[-1][2]):
            runs[-1][2] += 1
        else:
            runs.append([i, j, 1])
    out: list[list[int]] = []
    for i, j, n in reversed(runs):
        if out:
            i2, j2, n2 = out[-1]
            if (i + n == i2 and b[j2 - n:j2] == a[i:i + n]) or (j + n == j2 and a[i2 - n:i2] == b[j:j + n]):
                out[-1] = [i2 - n, j2 - n, n2 + n]
                continue
        out.append([i, j, n])
    return [(i + k, j + k) for i, j, n in reversed(out) for k in range(n)]


def patience(a: list[bytes], b: list[bytes]) -> list[tuple[int, int]]:
    """Patience diff of two line lists: aligned (position in a, position in b) in order."""
    out, gaps = [], [(0, len(a), 0, len(b))]
    while gaps:
        lo, hi, o_lo, o_hi = gaps.pop()
        while lo < hi and o_lo < o_hi and a[lo] == b[o_lo]:
            out.append((lo, o_lo))
            lo, o_lo = lo + 1, o_lo + 1
        while lo < hi and o_lo < o_hi and a[hi - 1] == b[o_hi - 1]:
            hi, o_hi = hi - 1, o_hi - 1
            out.append((hi, o_hi))
        here: dict[bytes, int] = {}
        there: dict[bytes, int] = {}
        for i in range(lo, hi):
            here[a[i]] = -1 if a[i] in here else i
        for j in range(o_lo, o_hi):
            there[b[j]] = -1 if b[j] in there else j
        unique = [(i, there[k]) for k, i in here.items() if i >= 0 and there.get(k, -1) >= 0]
        if unique:
            anchors = [unique[k] for k in longest_increasing([j for _, j in unique])]
            out += anchors
            edges = [(lo - 1, o_lo - 1), *anchors, (hi, o_hi)]
            gaps += [(i0 + 1, i1, j0 + 1, j1) for (i0, j0), (i1, j1) in zip(edges, edges[1:])]
        elif both := here.keys() & there.keys():
            i_at, j_at = [i for i in range(lo, hi) if a[i] in both], [j for j in range(o_lo, o_hi) if b[j] in both]
            out += [(i_at[i], j_at[j]) for i, j in common_subsequence([a[i] for i in i_at], [b[j] for j in j_at])]
    return joined_runs(sorted(out), a, b)


def pair_cut(keys: list[bytes], words: list[int], others: list[bytes], min_words: int) -> list[int]:
    """The line numbers that a document loses to an earlier one."""
    return enough(patience(keys, others), words, min_words)


def aligned_cuts(pairs: DataFrame, lists: DataFrame, min_words: int) -> DataFrame:
    """(rank, sig, gone): the line numbers that each pair's later document loses."""
    def listed(keys: bytes) -> list[bytes]:
        return [keys[i:i + 16] for i in range(0, len(keys), 16)]

    def run(it):
        for b in batches(it):
            gone = [pair_cut(listed(k), np.frombuffer(n, np.int32).tolist(), listed(o), min_words)
                    for k, n, o in zip(*(b.column(i).to_pylist() for i in (2, 3, 4)))]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(gone, pa.list_(pa.int32()))],
                                             names=["rank", "sig", "gone"])

    earlier = lists.selectExpr(*HOLDER, "keys as o_keys")
    both = pairs.join(earlier, ["o_rank", "o_sig"]).join(lists, ["rank", "sig"]).select("rank", "sig", "keys", "words", "o_keys")
    return both.mapInArrow(run, "rank bigint, sig bigint, gone array<int>").where(F.size("gone") > 0)


def gathered(cuts: DataFrame) -> DataFrame:
    return cuts.groupBy("rank", "sig").agg(F.array_distinct(F.flatten(F.collect_list("gone"))).alias("gone"))


def removals(docs: DataFrame, id_col: str, text_col: str, rare_docs: int, min_words: int) -> DataFrame:
    """(rank, sig, gone): the line numbers that each document loses."""
    lists = write_shared(line_lists(docs, id_col, text_col), "line-lists")
    known = shared_windows(lists, min_words)
    cuts = write_shared(gathered(aligned_cuts(first_pairs(known, rare_docs), lists, min_words)), "line-cuts")
    left, new, turn = known.where(follows() & (F.col("docs") > F.greatest(F.lit(rare_docs), F.lit(2)))).drop("o"), cuts, 0
    while True:
        stays = F.col("gone").isNull() | (F.size(F.array_except(F.sequence("start", F.col("end") - 1), "gone")) > 0)
        left = write_shared(left.join(new, ["rank", "sig"], "left").where(stays).drop("gone"), "line-left")
        last = left.agg(F.max(last_turn())).first()[0]
        if last is None or turn > last:
            return gathered(cuts)
        new = write_shared(gathered(aligned_cuts(next_pairs(left, known, turn), lists, min_words)), "line-cuts")
        cuts = cuts.union(new)
        new = gathered(cuts)  # the lines of a window may go in different rounds
        turn += 1


def remove_shared_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rare_docs: int = RARE_DOCS,
                        min_words: int = MIN_WORDS) -> DataFrame:
    """``docs`` without the lines of common blocks; columns stay as they are, plus
    ``_n_lines`` and ``_n_removed``."""
    gone = write_shared(removals(docs, id_col, text_col, rare_docs, min_words), "line-cuts").select(
        F.col("rank").alias("_rank"), F.col("sig").alias("_sig"), F.col("gone").alias("_gone"))
    rows = docs.join(gone, (F.xxhash64(whole_text(text_col)) == F.col("_sig"))
                     & (F.coalesce(F.col(id_col).cast("bigint"), F.lit(2 ** 63 - 1)) == F.col("_rank")), "left")
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields)

    def cut(it):
        for b in batches(it):
            texts = b.column(text_col).to_pylist()
            n_lines, n_gone = np.zeros(len(texts), np.int64), np.zeros(len(texts), np.int64)
            for i, gone in enumerate(b.column("_gone").to_pylist()):
                parts = split_lines(utf8(texts[i]))
                worded = [k for k, x in enumerate(parts) if x.split()]
                n_lines[i] = len(worded)
                if gone:
                    drop = {worded[p] for p in gone}
                    n_gone[i] = len(drop)
                    texts[i] = b"\n".join(x for k, x in enumerate(parts) if k not in drop).decode("utf-8", "surrogatepass")
            names = [n for n in b.schema.names if n != "_gone"]
            columns = [pa.array(texts, b.schema.field(n).type) if n == text_col else b.column(n) for n in names]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(n_lines), pa.array(n_gone)], names=[*names, "_n_lines", "_n_removed"])

    return rows.select(*docs.columns, "_gone").mapInArrow(cut, f"{kinds}, _n_lines bigint, _n_removed bigint")


def line_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rare_docs: int = RARE_DOCS,
               min_words: int = MIN_WORDS) -> DataFrame:
    """One row per document: doc_id, n_lines, n_removed, kept_sha256 (of the text that stays)."""
    picked = docs.select(F.col(id_col).alias("doc_id"), whole_text(text_col).alias("text"))
    rows = remove_shared_lines(picked, "doc_id", "text", rare_docs, min_words)
    return rows.select("doc_id", F.col("_n_lines").alias("n_lines"), F.col("_n_removed").alias("n_removed"),
                       F.sha2("text", 256).alias("kept_sha256"))


def keep_new_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rare_docs: int = RARE_DOCS,
                   min_words: int = MIN_WORDS) -> DataFrame:
    """``docs`` with the texts that stay, columns as they are (n_chars follows where there is one)."""
    out = remove_shared_lines(docs, id_col, text_col, rare_docs, min_words).select(*docs.columns)
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.char_length(whole_text(text_col)).cast(docs.schema["n_chars"].dataType))
    return out
