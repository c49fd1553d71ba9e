"""Near-duplicate detection by SimHash fingerprints and anchor-point covering.

Fingerprints: XXH64 (seed 42) of every word shingle, a bit set where more than half of the
hashes have it. Two documents are linked when their fingerprints differ in at most four
bits; a group is a connected component of links.

Search: the 64 bits are cut into six blocks, and ``TRIPLES`` names six sets of three blocks.
However four differing bits fall on the blocks, some triple holds at most one of them. On a
triple's 31 to 33 bits the anchors are the words of a Hamming code (31 bits, covering radius
1; bits beyond the 31 are free). A fingerprint is at home at its nearest anchor, at distance
1 or 0, and visits every anchor within radius + threshold = 2; where a triple differs in at
most one bit, one of the pair visits the other's home. Homes and visitors meet in a join on
the anchor and stay as a link when all 64 bits differ in at most four. Each fingerprint
has 6 homes and 17 visits or so per triple, whatever the number of documents; there are 2^26
anchors and more per triple.

Only distinct fingerprints are searched, so copies never meet each other, and a hot anchor
is split by Spark's skew join. Links go through ``components``; nothing is collected.

Null and empty texts have fingerprint zero and are linked like any other; null doc_ids take
part but never name a component unless all of its rows have none; repeated rows share their
component; an empty table gives an empty result; other columns are left alone.
"""

from __future__ import annotations

from itertools import accumulate

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window, functions as F

from bramble.llm.components import connected_components
from bramble.llm.shared import batches, record_batch, utf8, whole_text, write_shared

MAX_BITS = 4
BLOCKS = (11, 11, 11, 11, 10, 10)
# Any four or fewer differing bits leave some triple with at most one of them.
TRIPLES = ((0, 1, 2), (0, 1, 3), (0, 4, 5), (1, 4, 5), (2, 3, 4), (2, 3, 5))
CODE_BITS = 31

_LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))


def shingle_hashes(text: bytes, size: int) -> list[int]:
    """XXH64 of the space-joined shingles, repeats included; all words where there are fewer
    than ``size``; none without words."""
    words = text.translate(_LOWER).split()
    if not words:
        return []
    joined = b" ".join(words)
    if len(words) <= size:
        return [xxhash.xxh64_intdigest(joined, 42)]
    ends = list(accumulate(len(w) + 1 for w in words))
    starts = [0, *ends[:-1]]
    digest = xxhash.xxh64_intdigest
    return [digest(joined[a:b - 1], 42) for a, b in zip(starts, ends[size - 1:])]


def majority(hashes: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Per document (``counts`` consecutive hashes each, zero allowed) the word whose bits
    are set in over half of its hashes."""
    out = np.zeros(len(counts), np.uint64)
    some = np.flatnonzero(counts)
    if not len(some):
        return out
    # eight byte-wide counters in a 64-bit lane, so blocks of up to 255 hashes add at once
    spread = np.array([sum(((v >> j) & 1) << (8 * j) for j in range(8)) for v in range(256)], np.uint64)
    first = np.concatenate([[0], np.cumsum(counts[some])[:-1]])
    pieces = -(-counts[some] // 255)
    at = np.concatenate([f + 255 * np.arange(p) for f, p in zip(first, pieces)])
    sums = np.zeros((len(at), 8), np.uint64)
    for byte in range(8):
        lane = spread[(hashes >> np.uint64(8 * byte)).astype(np.uint8)]
        sums[:, byte] = np.add.reduceat(lane, at)
    per_piece = sums.view(np.uint8).astype(np.int64)
    per_doc = np.add.reduceat(per_piece, np.concatenate([[0], np.cumsum(pieces)[:-1]]), axis=0)
    bits = 2 * per_doc > counts[some][:, None]
    out[some] = np.packbits(bits, axis=1, bitorder="little").view(np.uint64)[:, 0]
    return out


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 4) -> DataFrame:
    """(doc_id, sig, fp): the fingerprint as a signed long; sig tells rows with the same
    doc_id but other texts apart."""
    id_type = docs.schema[id_col].dataType
    picked = docs.select(F.col(id_col).alias("doc_id"), F.xxhash64(whole_text(text_col)).alias("sig"), whole_text(text_col).alias("text"))

    def run(it):
        for b in batches(it):
            counts, hashes = [], []
            for text in b.column(2).to_pylist():
                h = shingle_hashes(utf8(text), shingle)
                counts.append(len(h))
                hashes.extend(h)
            fp = majority(np.array(hashes, np.uint64), np.array(counts, np.int64)).view(np.int64)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(fp)], names=["doc_id", "sig", "fp"])

    return picked.mapInArrow(run, f"doc_id {id_type.simpleString()}, sig bigint, fp bigint")


def triple_words(fp: np.ndarray) -> list[tuple[np.ndarray, int]]:
    """The bits of each triple as one number, and how many they are."""
    offset = np.concatenate([[0], np.cumsum(BLOCKS)])
    out = []
    for triple in TRIPLES:
        word, width = np.zeros(len(fp), np.uint64), 0
        for b in triple:
            part = (fp >> np.uint64(offset[b])) & np.uint64((1 << BLOCKS[b]) - 1)
            word |= part << np.uint64(width)
            width += BLOCKS[b]
        out.append((word, width))
    return out


def syndrome(word: np.ndarray) -> np.ndarray:
    """Hamming syndrome of the low 31 bits: 0 on the code, else the place (from 1) of the bit
    whose flip leads to it."""
    out = np.zeros(len(word), np.uint64)
    for j in range(5):
        mask = np.uint64(sum(1 << (p - 1) for p in range(1, CODE_BITS + 1) if p >> j & 1))
        out |= (np.bitwise_count(word & mask) & np.uint8(1)).astype(np.uint64) << np.uint64(j)
    return out


def _flip(place: np.ndarray) -> np.ndarray:
    """The bit at a place from 1; none for place 0."""
    one = np.uint64(1)
    return np.where(place == 0, np.uint64(0), one << (np.maximum(place, one) - one))


def anchors(fp: np.ndarray, visits: bool) -> tuple[np.ndarray, np.ndarray]:
    """(key, index into fp): the home anchor of each triple, or all anchors within two bits."""
    keys, rows, every = [], [], np.arange(len(fp))
    for t, (word, width) in enumerate(triple_words(fp)):
        s = syndrome(word)
        home = word ^ _flip(s)
        found = [(home, every)]
        if visits:
            # a free bit flipped at home: distance 2, or 1 where the word is on the code
            found += [(home ^ np.uint64(1 << j), every) for j in range(CODE_BITS, width)]
            # two code bits i < j with i ^ j equal to the syndrome: distance 2, off the code only
            for i in range(1, CODE_BITS + 1):
                j = s ^ np.uint64(i)
                ok = np.flatnonzero(j > np.uint64(i))
                ok = ok[s[ok] != 0]
                found.append((word[ok] ^ np.uint64(1 << (i - 1)) ^ _flip(j[ok]), ok))
        for k, r in found:
            keys.append(k | np.uint64(t << 40))
            rows.append(r)
    return np.concatenate(keys).view(np.int64), np.concatenate(rows)


def _place(fps: DataFrame, visits: bool) -> DataFrame:
    schema = pa.schema([("anchor", pa.int64()), ("fp", pa.int64())])

    def run(it):
        for b in batches(it, 1 << 16):
            fp = b.column(0).to_numpy().view(np.uint64)
            key, row = anchors(fp, visits)
            yield record_batch(schema, [key, fp.view(np.int64)[row]])

    return fps.select("fp").mapInArrow(run, "anchor bigint, fp bigint")


def links(fps: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """(a, b), a < b: all pairs of distinct fingerprints within ``max_bits`` bits."""
    if max_bits > MAX_BITS:
        raise ValueError(f"the cover finds pairs within {MAX_BITS} bits")
    # a task writes a hundred rows per fingerprint, so let no small partitions be merged
    fps = fps.repartition(int(fps.sparkSession.conf.get("spark.sql.shuffle.partitions")), "fp")
    home = _place(fps, False).withColumnRenamed("fp", "a")
    visitor = _place(fps, True).withColumnRenamed("fp", "b")
    near = (F.col("a") != F.col("b")) & (F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= max_bits)
    # each pair meets from both sides; one of them is enough. The planner takes a side to be as
    # large as the fingerprints, though it has 6 or 100 rows for each, so it must not broadcast one
    return (home.hint("merge").join(visitor.hint("merge"), (home["anchor"] == visitor["anchor"]) & near & (F.col("a") < F.col("b")))
            .select("a", "b").distinct())


def hex_digits(fp: str) -> Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


def _classes(prints: DataFrame, max_bits: int) -> DataFrame:
    """(fp, component): component is the least fingerprint linked to fp, itself included."""
    distinct = prints.select("fp").distinct()
    found = connected_components(links(distinct, max_bits))
    return (distinct.join(found, distinct["fp"] == found["node"], "left")
            .select("fp", F.coalesce("component", "fp").alias("component")))


def simhash_near_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 4,
                       max_bits: int = MAX_BITS) -> DataFrame:
    """One row per document: doc_id, fingerprint, component_id."""
    prints = write_shared(fingerprints(docs, id_col, text_col, shingle), "simhash-fingerprints")
    classes = write_shared(_classes(prints, max_bits), "simhash-classes")
    first = prints.groupBy("fp").agg(F.min("doc_id").alias("first"))
    named = (classes.join(first, "fp").groupBy("component").agg(F.min("first").alias("component_id"))
             .join(classes, "component").select("fp", "component_id"))
    return prints.join(named, "fp").select("doc_id", hex_digits("fp").alias("fingerprint"), "component_id")


def drop_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 4,
                         max_bits: int = MAX_BITS) -> DataFrame:
    """The rows of ``docs`` with one of each component: the smallest doc_id, null last; of
    rows that agree on doc_id and text one stays. Columns stay as they are."""
    prints = write_shared(fingerprints(docs, id_col, text_col, shingle), "simhash-fingerprints")
    classes = write_shared(_classes(prints, max_bits), "simhash-classes")
    order = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "sig")
    stays = (prints.groupBy("fp").agg(F.min(order).alias("row")).join(classes, "fp")
             .groupBy("component").agg(F.min("row").alias("row"))
             .select(F.col("row.doc_id").alias("_stay_id"), F.col("row.sig").alias("_stay_sig")))
    kept = docs.withColumn("_sig", F.xxhash64(whole_text(text_col))).join(
        stays, F.col("_sig").eqNullSafe(F.col("_stay_sig")) & F.col(id_col).eqNullSafe(F.col("_stay_id")), "left_semi")
    again = Window.partitionBy(id_col, "_sig").orderBy(F.lit(0))
    return kept.withColumn("_again", F.row_number().over(again)).where("_again = 1").select(*docs.columns)
