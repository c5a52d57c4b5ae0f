"""Quality classifier: logistic regression on hashed word n-grams, trained by follow-the-regularised-leader.

A text's features are its words, its pairs of adjacent words and the same of the words' shapes (runs of lower-case
letters, capitals and digits as one character each), hashed into one table; a pair of equal words is one feature,
whatever the word. Each shard of a bounded sample of labelled documents trains on its own, in an order fixed by the
documents' ids, and the shards' weights are averaged. Scoring is a sparse dot product per text and needs no shuffle.
"""

from __future__ import annotations

from collections import deque
from collections.abc import Iterable, Iterator
from functools import partial
from itertools import groupby

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from terraflux.llm.common import table
from terraflux.llm.words import Words, chunks, mix

BITS = 18
#: Labelled documents that training takes at most (by the hash of their id, so give or take a few), and their shards.
MAX_TRAIN, SHARDS, EPOCHS = 24_000, 4, 3
#: Bytes of text that training takes at most (likewise); fewer documents are drawn if they are long. A shard holds eight bytes for each distinct feature of each text.
MAX_TRAIN_BYTES = 96_000_000
#: Bytes of text whose words are looked at together.
CHUNK = 250_000
#: Rows that a worker hands on at a time.
SLICE = 500
#: Learning rate and its offset, L1 and L2 of the leader's regularisation.
ALPHA, BETA, L1, L2 = 0.1, 1.0, 0.05, 0.1

_SHAPE = np.arange(256, dtype=np.uint8)
_SHAPE[97:123] = _SHAPE[128:] = ord("a")
_SHAPE[65:91] = ord("A")
_SHAPE[48:58] = ord("0")


def features(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(slots, first): the slots of all texts' features; those of text r are slots[first[r]:first[r + 1]]."""
    words = Words.of(texts)
    shape = _SHAPE[words.buf]
    changes = np.append(True, shape[1:] != shape[:-1])[: len(shape)]
    shapes = Words.of([shape[changes].tobytes()])
    last = np.zeros(len(words.start), bool)
    last[words.first[1:][np.diff(words.first) > 0] - 1] = True
    found = []
    for i, w in enumerate((words, shapes)):
        one = w.hashes(w.prefix())
        two = mix(one + np.uint64(2 * i + 1) * np.roll(one, -1))
        equal, end = mix(np.array([2 * i + 1, 2 * i + 2], np.uint64) << np.uint64(32))
        two[one == np.roll(one, -1)] = equal
        found += [mix(one + np.uint64(i + 7)), np.where(last, end, two)]
    slots = (np.stack(found, 1).reshape(-1) >> np.uint64(64 - BITS)).astype(np.int32) if len(words.start) else np.empty(0, np.int32)
    return slots, words.first * len(found)


def train(examples: Iterable[tuple[np.ndarray, int]], epochs: int) -> tuple[np.ndarray, float]:
    """Weights and bias after FTRL-proximal over (slots, label) in the given order; of an example its distinct slots are held."""
    z, n = np.zeros(1 + (1 << BITS)), np.zeros(1 + (1 << BITS))

    def weights(at: np.ndarray) -> np.ndarray:
        own = z[at]
        return np.where(np.abs(own) <= L1, 0.0, -(own - np.sign(own) * L1) / ((BETA + np.sqrt(n[at])) / ALPHA + L2))

    ready = []
    for slots, label in examples:
        at, count = np.unique(slots, return_counts=True)
        ready.append((np.append(at, 1 << BITS).astype(np.int32), count.astype(np.int32), len(slots), label))
    for _ in range(epochs):
        for at, count, size, label in ready:
            x = np.append(count / max(1, size) ** 0.5, 1.0)
            w = weights(at)
            g = (1 / (1 + np.exp(-np.clip(w @ x, -35, 35))) - label) * x
            sigma = (np.sqrt(n[at] + g * g) - np.sqrt(n[at])) / ALPHA
            z[at] += g - sigma * w
            n[at] += g * g
    every = weights(np.arange(len(z)))
    return every[:-1], float(every[-1])


def held_out(doc_id: str | Column = "doc_id") -> Column:
    """Rows that labels are never learned from: crc32 of the doc_id as text, modulo 3, is 1. A null doc_id is not."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 3 == 1, F.lit(False))


def fit(docs: DataFrame, labels: DataFrame, *, max_train: int = MAX_TRAIN, max_bytes: int = MAX_TRAIN_BYTES, epochs: int = EPOCHS) -> tuple[np.ndarray, float]:
    """Weights and bias learned from at most about max_train labelled documents, of max_bytes in all, outside the held-out third.

    Null labels are left out. Without any labelled row all weights are 0.
    """
    usable = labels.select("doc_id", F.col("quality").cast("int").alias("quality")).dropna().filter(~held_out()).groupBy("doc_id").agg(F.max("quality").alias("quality"))
    share = min(1.0, max_train / max(1, usable.count()))
    order = F.pmod(F.xxhash64(F.lit("train"), "doc_id"), F.lit(1_000_000))

    def drawn(share: float) -> DataFrame:
        chosen = F.broadcast(usable.withColumn("place", order).filter(F.col("place") < share * 1_000_000))  # max_train rows of 20 bytes
        return docs.select("doc_id", "text").join(chosen, "doc_id").withColumn("shard", F.col("place") % SHARDS)

    size = drawn(share).agg(F.sum(F.octet_length("text"))).first()[0] or 0
    sample = drawn(share * min(1.0, max_bytes / max(1, size)))

    # a row at a time and in order, so that a worker holds the features of one shard and no texts
    dealt = sample.select("shard", "text", "quality", "place", "doc_id").repartition("shard").sortWithinPartitions("shard", "place", "doc_id", F.asc_nulls_last("text"))
    learned = dealt.select("shard", "text", "quality").mapInArrow(partial(_learned, epochs=epochs), "slot int, w double")
    summed = learned.groupBy("slot").agg(F.sum("w").alias("w"), F.count("*").alias("n"))
    found = summed.toArrow()  # at most a row per slot
    slot, total, n = (found[c].to_numpy() for c in ("slot", "w", "n"))
    shards = max(1, int(n[slot == -1].sum()))
    w = np.zeros(1 << BITS, np.float32)
    w[slot[slot >= 0]] = total[slot >= 0] / shards
    return w, float(total[slot == -1].sum() / shards)


def _learned(batches: Iterator[pa.RecordBatch], epochs: int) -> Iterator[pa.RecordBatch]:
    """The weights other than 0 of each shard, its bias at slot -1, of rows (shard, text, quality) in the order of shards and of training."""
    rows = (row for batch in batches for row in zip(batch.column(0), batch.column(1), batch.column(2)))
    for _, own in groupby(rows, lambda row: row[0].as_py()):
        w, bias = train(_examples(own), epochs)
        at = np.flatnonzero(w)
        yield pa.RecordBatch.from_arrays([pa.array(np.append(at, -1), pa.int32()), pa.array(np.append(w[at], bias))], ["slot", "w"])


def _examples(rows: Iterator[tuple[pa.Scalar, ...]]) -> Iterator[tuple[np.ndarray, int]]:
    labels = deque()

    def texts() -> Iterator[str | None]:
        for _, text, label in rows:
            labels.append(label.as_py())
            yield text.as_py()

    for _, held in chunks(texts(), CHUNK):
        slots, first = features(held)
        for begin, end in zip(first, first[1:]):
            yield slots[begin:end], labels.popleft()


def _score(texts: pa.Array, w: np.ndarray, bias: float) -> pa.Array:
    out = []
    for _, held in chunks((text.as_py() for text in texts), CHUNK):
        slots, first = features(held)
        n = np.diff(first)
        sums = np.zeros(len(n))
        if len(slots):  # by text, so that a score does not depend on its neighbours
            sums[n > 0] = np.add.reduceat(w[slots].astype(np.float64), first[:-1][n > 0])
        out.append(1 / (1 + np.exp(-np.clip(bias + sums / np.sqrt(np.maximum(n, 1)), -35, 35))))
    return pa.array(np.round(np.concatenate(out), 6) if out else [], pa.float64())


def _scores(batches: Iterator[pa.RecordBatch], w: np.ndarray, bias: float) -> Iterator[pa.RecordBatch]:
    """(doc_id, score) of rows (doc_id, text)."""
    for batch in batches:
        yield pa.RecordBatch.from_arrays([batch.column(0), _score(batch.column(1), w, bias)], [batch.schema.names[0], "score"])


def _passed(batches: Iterator[pa.RecordBatch], w: np.ndarray, bias: float, text: int) -> Iterator[pa.RecordBatch]:
    """Rows, as one struct whose field of that number is the text, that score 0.5 or more; a text travels once."""
    for batch in batches:
        passed = pc.greater_equal(_score(batch.column(0).field(text), w, bias), 0.5)
        for begin in range(0, batch.num_rows, SLICE):
            yield batch.slice(begin, SLICE).filter(passed.slice(begin, SLICE))


def score(docs: DataFrame, w: np.ndarray, bias: float) -> DataFrame:
    """One row per row of docs: doc_id, held_out, score, predicted. Null and empty texts score the bias alone."""
    scored = docs.select("doc_id", "text").mapInArrow(partial(_scores, w=w, bias=bias), f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, score double")
    return scored.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def drop_low_quality(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """docs, all columns whatever their names, without the documents that the classifier rejects.

    Null and empty texts score the bias alone; repeated rows stay or go together; without any label all rows stay.
    """
    w, bias = fit(docs, labels)
    text = docs.columns.index("text") if "text" in docs.columns else [name.lower() for name in docs.columns].index("text")
    rows = docs.select(F.struct("*").alias("row"))
    return rows.mapInArrow(partial(_passed, w=w, bias=bias, text=text), f"row {docs.schema.simpleString()}").select("row.*")


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    return score(docs, *fit(docs, labels))
