"""Quality classifier: supervised subword embeddings, trained by numpy stochastic gradient
descent.

A word is its own hash and the hashes of its character 3- and 4-grams (with word ends); each
hash has a learned vector. A word's vector is the mean of those; a document's the mean over
its words, one word 2-gram for each word that repeats the one before, and a few pads; a softmax layer on it gives the class. Training sees a bounded sample of
labelled rows (``train_rows``, the first by a hash of doc_id, half of each class where there
are enough), and only those whose crc32(doc_id as text) mod 5 is not 0. Features come from
the text alone. Feature lists are made in parallel; one task holds the bounded sample and runs
the epochs in a fixed order, so a retried task gives the same model.

With two classes the score is a logistic function of a mean over words, so the model folds to
one number per hash (``Model.fold``); every task scores whole texts with it, each different
word of a batch once.

Null and empty texts are scored by the pads alone; labels that are null or of unknown
documents are not used, repeated labels of one document count once by the largest, repeated
rows of one doc_id train once by their least text; without
labels of both classes every score is 0.5; an empty table gives an empty result; other
columns are not read.
"""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass
from itertools import islice
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from bramble.llm.shared import batches, utf8, whole_text
from bramble.llm.textbytes import Rolling, mix

LOG_BUCKETS = 18
DIM = 16
THRESHOLD = 0.3
PAD, ECHO, PADS = b" pad", b" echo", 8  # with a blank, so no word is equal to them


class Buckets:
    """Buckets of many words at once: the whole word and its character 3- and 4-grams, each
    by a rolling hash of its code points."""

    def __init__(self):
        self.rolling = Rolling(0x9E3779B97F4A7C15)

    def of(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(buckets, the word each belongs to, number of buckets per word)."""
        texts = [f"<{w.decode('utf-8', 'replace')}>" for w in words]
        size = np.array([len(t) for t in texts])
        start = np.concatenate([[0], np.cumsum(size)[:-1]])
        code = np.frombuffer("".join(texts).encode("utf-32-le", "replace"), np.uint32).astype(np.uint64)
        owner = np.repeat(np.arange(len(texts)), size)
        room = np.repeat(start + size, size) - np.arange(len(code))  # characters from here to the word's end
        prefix = self.rolling.prefix(code + np.uint64(1))
        ids, of_word = [self.rolling.spans(prefix, start, start + size)], [np.arange(len(texts))]
        for n in (3, 4):
            at = np.flatnonzero(room >= n)
            ids.append(self.rolling.spans(prefix, at, at + n) ^ np.uint64(n * 0x5851F42D4C957F2D & (1 << 64) - 1))
            of_word.append(owner[at])
        bucket = (mix(np.concatenate(ids)) >> np.uint64(64 - LOG_BUCKETS)).astype(np.int64)
        of_word = np.concatenate(of_word)
        return bucket, of_word, np.bincount(of_word, minlength=len(texts))

    def means(self, words: list[bytes], table: np.ndarray) -> np.ndarray:
        """Mean of the table over each word's buckets."""
        bucket, of_word, n = self.of(words)
        return np.bincount(of_word, table[bucket], len(words)) / n


def document_words(text: bytes) -> tuple[list[bytes], int, int]:
    """(words, repeats of the word before, number of all items). Items are the words, one
    word 2-gram (``ECHO``) per repeat, and ``PADS`` pads that steady short texts."""
    words = text.split()
    echoes = sum(map(eq, words, islice(words, 1, None)))
    return words, echoes, len(words) + echoes + PADS


def document_features(text: bytes, buckets: Buckets) -> tuple[np.ndarray, np.ndarray]:
    """(buckets, weights) of a document: distinct, in order, weights adding up to 1."""
    words, echoes, items = document_words(text)
    counts = Counter(words)
    counts[PAD] = PADS
    if echoes:
        counts[ECHO] = echoes
    bucket, of_word, n = buckets.of(list(counts))
    weight = np.fromiter(counts.values(), float, len(counts)) / (items * n)
    distinct, where = np.unique(bucket, return_inverse=True)
    return distinct.astype(np.int32), np.bincount(where, weight[of_word]).astype(np.float32)


@dataclass
class Model:
    embedding: np.ndarray  # (buckets, DIM)
    output: np.ndarray     # (2, DIM)
    bias: np.ndarray       # (2,)

    def fold(self) -> tuple[np.ndarray, float]:
        """Log-odds of class 1: one number per bucket, and a constant."""
        return self.embedding @ (self.output[1] - self.output[0]), float(self.bias[1] - self.bias[0])


def train(samples: list[tuple[int, np.ndarray, np.ndarray]], epochs: int = 4, rate: float = 20.0, seed: int = 7) -> Model:
    """Softmax regression on mean embeddings; one document a step, the rate falling to 0."""
    rng = np.random.default_rng(seed)
    e = rng.uniform(-0.5, 0.5, (1 << LOG_BUCKETS, DIM)).astype(np.float32)
    w, b = np.zeros((2, DIM), np.float32), np.zeros(2, np.float32)
    steps, done = epochs * len(samples), 0
    for _ in range(epochs):
        for k in rng.permutation(len(samples)):
            y, ids, weight = samples[k]
            v = weight @ e[ids]
            z = w @ v + b
            p = np.exp(z - z.max())
            p /= p.sum()
            p[y] -= 1
            now = 1 - done / steps
            back = p @ w
            w -= (0.5 * now) * np.outer(p, v).astype(np.float32)
            b -= (0.05 * now) * p.astype(np.float32)
            e[ids] -= (rate * now) * np.outer(weight, back)
            done += 1
    return Model(e, w, b)


def held_out(id_col: str) -> Column:
    return F.crc32(F.col(id_col).cast("string").cast("binary")) % 5 == 0


def training_rows(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, train_rows: int) -> DataFrame:
    """(order, label, text) of the labelled sample: ``train_rows`` rows at most, one a label. Of
    several rows with one id the least text is taken, found on the mappers."""
    known = (labels.where("doc_id is not null and quality in (0, 1)").groupBy("doc_id").agg(F.max("quality").alias("label"))
             .where(~held_out("doc_id")).withColumn("order", F.xxhash64("doc_id")))
    picked = [known.where(F.col("label") == c).orderBy("order", "doc_id").limit(train_rows // 2) for c in (0, 1)]
    sample = picked[0].union(picked[1]).withColumnRenamed("doc_id", "_label_id")
    return (docs.select(F.col(id_col).alias("_id"), whole_text(text_col).alias("text"))
            .join(F.broadcast(sample), F.col("_id") == F.col("_label_id"))  # train_rows rows at most
            .groupBy("_id", "order", "label").agg(F.min("text").alias("text")).select("order", "label", "text"))


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
        train_rows: int = 4000) -> tuple[np.ndarray, float] | None:
    """The folded model (one number per bucket, and a constant), or None without labels of
    both classes. The vectors stay in the training task; 1 MB comes to the driver."""
    def features(it):
        buckets = Buckets()
        for b in batches(it):
            made = [document_features(utf8(t), buckets) for t in b.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.array([m[0].tobytes() for m in made]), pa.array([m[1].tobytes() for m in made])],
                names=["order", "label", "ids", "weights"])

    def learn(it):
        samples = []
        for b in it:
            for y, i, w in zip(*(b.column(k).to_pylist() for k in (1, 2, 3))):
                samples.append((y, np.frombuffer(i, np.int32), np.frombuffer(w, np.float32)))
        if len({y for y, _, _ in samples}) == 2:
            table, constant = train(samples).fold()
            yield pa.RecordBatch.from_arrays([pa.array([table.astype(np.float32).tobytes()]), pa.array([constant])],
                                             names=["fold", "constant"])

    rows = training_rows(docs, labels, id_col, text_col, train_rows)
    lists = rows.mapInArrow(features, "order bigint, label int, ids binary, weights binary")
    # one task on purpose: a bounded sample, in one order whatever the partitions were
    made = (lists.repartition(1).sortWithinPartitions("order", "ids")
            .mapInArrow(learn, "fold binary, constant double").collect())
    return (np.frombuffer(bytes(made[0].fold), np.float32), made[0].constant) if made else None


def scores(docs: DataFrame, model: tuple[np.ndarray, float] | None, text_col: str = "text", name: str = "score") -> DataFrame:
    """``docs`` and a column ``name``: the probability of class 1."""
    table, constant = model or (np.zeros(1 << LOG_BUCKETS, np.float32), 0.0)
    shared = docs.sparkSession.sparkContext.broadcast(table)  # 2^18 numbers

    def run(it):
        table, buckets = shared.value, Buckets()
        pad, echo = buckets.means([PAD, ECHO], table).tolist()
        for b in batches(it, 1 << 20):
            read = [document_words(utf8(t)) for t in b.column(text_col).to_pylist()]
            different = list(set().union(*(w for w, _, _ in read)))
            value = dict(zip(different, buckets.means(different, table).tolist() if different else ())).__getitem__
            out = [constant + (PADS * pad + echoes * echo + sum(map(value, words))) / items for words, echoes, items in read]
            z = np.clip(np.array(out), -700, 700)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(1 / (1 + np.exp(-z)))], names=[*b.schema.names, name])

    return docs.mapInArrow(run, StructType([*docs.schema.fields, StructField(name, DoubleType())]))


def quality_classifier(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                       train_rows: int = 4000) -> DataFrame:
    """One row per document: doc_id, held_out, score, predicted."""
    model = fit(docs, labels, id_col, text_col, train_rows)
    rows = scores(docs.select(F.col(id_col).alias("doc_id"), whole_text(text_col).alias("text")), model)
    return rows.select("doc_id", F.coalesce(held_out("doc_id"), F.lit(False)).alias("held_out"), "score",
                       (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))


def keep_good(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
              train_rows: int = 4000) -> DataFrame:
    """The rows of ``docs`` that the classifier does not reject, columns as they are."""
    model = fit(docs, labels, id_col, text_col, train_rows)
    return scores(docs, model, text_col, "_p_good").where(F.col("_p_good") >= THRESHOLD).select(*docs.columns)
