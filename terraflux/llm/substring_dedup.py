"""Substring dedup by super-k-mer partitioning.

The minimiser of a window of 13 words is the least hash of its 3-word parts. Consecutive windows with one minimiser
travel as one packed string to that minimiser's bucket, those of one task for one bucket in one compressed row. There
the windows are sorted by hash, equal ones confirmed by their bytes, and each distinct window gets the smallest doc_id
that has it. A second scan of the documents looks its packed strings up among those with a shared window and covers
the words to remove.

Copies are merged before the shuffle (per packed string: smallest and largest doc_id), so a passage that a third of
all documents share sends one string per task. A minimiser that many different windows share sends its windows one by one,
dealt by the window itself. A sample of the documents tells such minimisers and the number of buckets; it decides only
where strings travel, not what is found.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from terraflux.llm.common import cut, table
from terraflux.llm.words import Words, chunks, mix

N, PART = 13, 3
#: The seed of Spark's xxhash64().
SPARK_SEED = 42
#: Bytes of text whose packed strings are merged before they travel.
MAP_BYTES = 8_000_000
#: Windows in one packed string at most; longer runs of one minimiser are split.
RUN = 256
#: Share of the documents that is scanned to plan the buckets, and packed bytes that a bucket should have.
PLAN_SAMPLE, BUCKET_BYTES = 0.02, 4_000_000
#: Buckets that a task takes one after another; a job of more than MAX_TASKS tasks gives each more of them.
TASK_BUCKETS, MAX_TASKS = 8, 200_000
#: Minimisers that are sent window by window, at most (8 bytes each in every task): the most frequent ones.
MAX_HOT = 1_000_000


def _among(m: np.ndarray, hot: np.ndarray) -> np.ndarray:
    """Whether each of m is in the sorted array hot."""
    if not len(hot):
        return np.zeros(len(m), bool)
    return hot[np.minimum(np.searchsorted(hot, m), len(hot) - 1)] == m


def _minimisers(words: Words, prefix: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The minimiser of the window at each word, and whether there is a whole window at it."""
    n = len(words.start)
    if n < N:
        return np.empty(0, np.uint64), np.zeros(0, bool)
    m = words.hashes(prefix, PART)
    for step in (1, 2, 4, N - PART - 7):  # least of 2, 4, 8, then of all N - PART + 1 parts
        m = np.minimum(m[:-step], m[step:])
    last = np.repeat(words.first[1:], np.diff(words.first))[: len(m)]
    return m, np.arange(len(m)) + N <= last


def _runs(m: np.ndarray, whole: np.ndarray, hot: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and last window of each packed string."""
    same = np.zeros(len(m), bool)
    same[1:] = whole[1:] & whole[:-1] & (m[1:] == m[:-1])
    if len(hot):
        same &= ~_among(m, hot)
    head = np.zeros(len(m), np.int64)
    heads = np.flatnonzero(~same)
    head[heads] = heads
    place = np.arange(len(m)) - np.maximum.accumulate(head)
    starts = np.flatnonzero(whole & (~same | (place % RUN == 0)))
    begins = np.zeros(len(m) + 1, bool)
    begins[starts] = True
    begins[-1] = True
    ends = np.flatnonzero(whole & (begins[1:] | ~np.append(whole[1:], False)))
    return starts, ends


def _packed(texts: list[bytes], hot: np.ndarray) -> tuple[Words, np.ndarray, np.ndarray, np.ndarray, list[bytes]]:
    words = Words.of(texts)
    prefix = words.prefix()
    m, whole = _minimisers(words, prefix)
    starts, ends = _runs(m, whole, hot)
    route = m[starts]
    if len(hot) and len(starts):
        route = np.where(_among(route, hot), words.hashes(prefix, N)[starts], route)
    return words, starts, np.searchsorted(words.first, starts, "right") - 1, route, words.slices(words.start[starts], words.end[ends + N - 1])


def _keys(packed: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(map(xxhash.xxh3_128_digest, packed)), np.int64).reshape(-1, 2)


def _texts(batches: Iterator[pa.RecordBatch], rows: int = 500) -> Iterator[tuple[np.ndarray, list[bytes]]]:
    """doc_ids and texts of the rows that have a doc_id, some megabytes at a time."""
    for batch in batches:
        batch = batch.filter(batch.column(0).is_valid())
        ids = batch.column(0).to_numpy(zero_copy_only=False).astype(np.int64)
        for begin in range(0, len(ids), rows):
            for first, texts in chunks(batch.column(1).slice(begin, rows).to_pylist()):
                yield ids[begin + first : begin + first + len(texts)], texts


def plan_buckets(docs: DataFrame) -> tuple[int, np.ndarray]:
    """The number of buckets, and in order the minimisers that would fill a quarter of one or more."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, texts in _texts(batches):
            route, packed = _packed(texts, np.empty(0, np.uint64))[3:]
            # copies of one packed string are merged before they travel
            once = dict(zip(packed, route.tolist()))
            values, at = np.unique(np.fromiter(once.values(), np.uint64, len(once)), return_inverse=True)
            size = np.bincount(at, np.fromiter(map(len, once), np.int64, len(once)), len(values)).astype(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(values.view(np.int64)), pa.array(size)], ["m", "n"])

    share = int(PLAN_SAMPLE * 10_000)
    sizes = docs.filter(F.pmod(F.xxhash64("doc_id"), F.lit(10_000)) < share).mapInArrow(run, "m long, n long").groupBy("m").agg(F.sum("n").alias("n"))
    sizes = cut(sizes.filter("n > 500"), "sub-plan")  # one string seldom tells anything
    total = docs.select(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = max(64, int(3 * total / BUCKET_BYTES))
    hot = sizes.filter(F.col("n") > max(2000, BUCKET_BYTES * PLAN_SAMPLE / 4)).orderBy(F.desc("n"), "m").limit(MAX_HOT)
    return buckets, np.sort(np.array([r[0] for r in hot.select("m").collect()], np.int64).view(np.uint64))


def _pack(docs: DataFrame, hot: np.ndarray, buckets: int) -> DataFrame:
    """(bucket, packed, docs): packed strings by line, and the smallest and largest doc_id of each, both compressed."""

    def merged(seen: dict[bytes, list[int]]) -> pa.RecordBatch:
        strings, (to, lo, hi) = list(seen), np.array(list(seen.values()), np.int64).T
        order, pack = np.argsort(to, kind="stable"), zstandard.ZstdCompressor(3).compress
        heads = np.flatnonzero(np.append(True, np.diff(to[order]) != 0))
        out: tuple[list, list] = ([], [])
        for own in np.split(order, heads[1:]):
            out[0].append(pack(b"\n".join([strings[i] for i in own.tolist()]) + b"\n"))
            out[1].append(pack(np.concatenate([np.diff(lo[own], prepend=0), hi[own] - lo[own]]).tobytes()))
        return pa.RecordBatch.from_arrays([pa.array(to[order[heads]]), pa.array(out[0], pa.binary()), pa.array(out[1], pa.binary())], ["bucket", "packed", "docs"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[bytes, list[int]] = {}  # bucket, smallest and largest doc_id of each packed string
        size = 0
        for ids, texts in _texts(batches):
            _, _, row, route, packed = _packed(texts, hot)
            for string, bucket, doc in zip(packed, (route % np.uint64(buckets)).tolist(), ids[row].tolist()):
                if own := seen.get(string):
                    if doc < own[1]:
                        own[1] = doc
                    if doc > own[2]:
                        own[2] = doc
                else:
                    seen[string] = [bucket, doc, doc]
            size += sum(map(len, texts))
            if size >= MAP_BYTES and seen:
                yield merged(seen)
                seen, size = {}, 0
        if seen:
            yield merged(seen)

    return docs.select("doc_id", "text").mapInArrow(run, "bucket long, packed binary, docs binary")


def _first_documents(words: Words, lo: np.ndarray, hi: np.ndarray) -> list[tuple[int, np.ndarray]]:
    """(index, smallest doc_id of each window) of the packed strings with a window that two documents have."""
    key = words.hashes(words.prefix(), N)
    of = np.repeat(np.arange(len(lo)), np.diff(words.first))[: len(key)]
    at = np.flatnonzero(np.arange(len(key)) + N <= words.first[of + 1])
    order = at[np.argsort(key[at], kind="stable")]
    heads = np.flatnonzero(np.append(True, key[order][1:] != key[order][:-1]))
    least, most = np.minimum.reduceat(lo[of[order]], heads), np.maximum.reduceat(hi[of[order]], heads)
    sizes = np.diff(np.append(heads, len(order)))
    first = np.zeros(len(key), np.int64)
    first[order] = np.repeat(least, sizes)
    shared = np.zeros(len(key), bool)
    shared[order] = np.repeat(least < most, sizes)
    many = np.repeat((sizes > 1) & (least < most), sizes)
    text = words.slices(words.start[order[many]], words.end[order[many] + N - 1])
    group = np.repeat(np.arange(len(heads)), sizes)[many].tolist()
    odd = {g for g, before, t, u in zip(group[1:], group, text[1:], text) if g == before and t != u}
    for g in odd:  # different windows with one hash
        inside = order[heads[g] : heads[g] + sizes[g]]
        exact: dict[bytes, list[int]] = {}
        for i, t in zip(inside.tolist(), words.slices(words.start[inside], words.end[inside + N - 1])):
            exact.setdefault(t, []).append(i)
        for own in exact.values():
            first[own] = lo[of[own]].min()
            shared[own] = lo[of[own]].min() < hi[of[own]].max()
    hit = np.unique(of[np.flatnonzero(shared)])
    return [(i, first[words.first[i] : words.first[i + 1] - N + 1]) for i in hit.tolist()]


def shared_windows(packed: DataFrame, buckets: int) -> DataFrame:
    """(ka, kb, firsts) of the packed strings with a shared window: their 128-bit digest, the smallest doc_id of each window.

    Buckets are dealt to tasks in turn, as many tasks as the buckets need, so that none has more than its share.
    """

    def bucket(lines: list[bytes], docs: list[bytes]) -> Iterator[pa.RecordBatch]:
        words = Words.of_lines(b"".join(lines))
        both = [np.frombuffer(d, np.int64).reshape(2, -1) for d in docs]
        lo = np.concatenate([np.cumsum(b[0]) for b in both])
        found = _first_documents(words, lo, lo + np.concatenate([b[1] for b in both]))
        at = np.array([i for i, _ in found], np.int64)
        strings = words.slices(words.start[words.first[at]], words.end[words.first[at + 1] - 1])
        once = {s: f for s, (_, f) in zip(strings, found)}
        if once:
            keys = _keys(list(once))
            offsets = np.concatenate([[0], np.cumsum([len(f) for f in once.values()])]).astype(np.int32)
            firsts = pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(list(once.values()))))
            yield pa.RecordBatch.from_arrays([pa.array(keys[:, 0]), pa.array(keys[:, 1]), firsts], ["ka", "kb", "firsts"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_ = zstandard.ZstdDecompressor()
        now, lines, docs = None, [], []
        for batch in batches:
            for i, number in enumerate(batch.column(0).to_pylist()):
                if number != now and lines:
                    yield from bucket(lines, docs)
                    lines, docs = [], []
                now = number
                lines.append(open_.decompress(batch.column(1)[i].as_py()))
                docs.append(open_.decompress(batch.column(2)[i].as_py()))
        if lines:
            yield from bucket(lines, docs)

    tasks = min(MAX_TASKS, max(1, -(-buckets // TASK_BUCKETS)))
    dealt = packed.repartitionById(tasks, (F.col("bucket") % tasks).cast("int"))
    return dealt.sortWithinPartitions("bucket").mapInArrow(run, "ka long, kb long, firsts array<long>")


def _occurrences(docs: DataFrame, hot: np.ndarray) -> DataFrame:
    """(ka, kb, doc_id, fp, at): the packed strings of each document, xxhash64 of its text and the word at which they begin."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, texts in _texts(batches):
            words, starts, row, _, packed = _packed(texts, hot)
            keys = _keys(packed)
            fps = np.fromiter((xxhash.xxh64_intdigest(t, SPARK_SEED) for t in texts), np.uint64, len(texts)).view(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(keys[:, 0]), pa.array(keys[:, 1]), pa.array(ids[row]), pa.array(fps[row]), pa.array(starts - words.first[row])], ["ka", "kb", "doc_id", "fp", "at"])

    return docs.select("doc_id", "text").mapInArrow(run, "ka long, kb long, doc_id long, fp long, at long")


def remove_repeats(docs: DataFrame) -> DataFrame:
    """One row per row of docs: doc_id, n_words, n_removed, kept (the words left, joined by one space).

    A word goes if a window of 13 words that covers it also starts in a document with a smaller doc_id, judged on the
    whole input. Null and wordless texts have no words; texts of fewer than 13 words lose none. A row without doc_id
    is no source and loses nothing. Rows that repeat a doc_id are judged each by its own text, and are no sources for one
    another. Other columns are ignored; an empty table gives an empty result.
    """
    docs = docs.select(F.col("doc_id").cast("long"), "text")
    buckets, hot = plan_buckets(docs)
    shared = cut(shared_windows(_pack(docs, hot, buckets), buckets), "sub-shared")
    found = _occurrences(docs, hot).join(shared, ["ka", "kb"])
    found = found.select("doc_id", "fp", "at", F.transform("firsts", lambda f: f < F.col("doc_id")).alias("gone")).filter(F.exists("gone", lambda g: g))
    gone = cut(found.select("doc_id", "fp", F.struct(F.col("at"), F.col("gone").alias("windows")).alias("run")).groupBy("doc_id", "fp").agg(F.collect_set("run").alias("runs")), "sub-gone")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, runs = batch.column(1), batch.column(2)
            n_words, n_removed, kept = [], [], []
            for text, own in ((t.as_py(), r.as_py()) for t, r in zip(texts, runs)):
                words = (text or "").encode().split()
                n_words.append(len(words))
                if not own:
                    n_removed.append(0)
                    kept.append(b" ".join(words).decode())
                    continue
                covered = np.zeros(len(words) + 1, np.int64)
                for r in own:
                    starts = r["at"] + np.flatnonzero(r["windows"])
                    starts = starts[starts + N <= len(words)]
                    np.add.at(covered, starts, 1)
                    np.add.at(covered, starts + N, -1)
                stay = np.cumsum(covered)[: len(words)] == 0
                n_removed.append(int((~stay).sum()))
                kept.append(b" ".join(w for w, s in zip(words, stay.tolist()) if s).decode())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()), pa.array(kept, pa.string())], ["doc_id", "n_words", "n_removed", "kept"])

    return docs.withColumn("fp", F.xxhash64("text")).join(gone, ["doc_id", "fp"], "left").select("doc_id", "text", "runs").mapInArrow(run, "doc_id long, n_words long, n_removed long, kept string")


def op9_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(table(spark, sf_dir, "documents")).select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


OP9_SQL = r"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents
), x AS (
  SELECT doc_id, i, array_to_string(w[i:i + 12], ' ') AS t FROM (SELECT doc_id, w, unnest(range(1, len(w) - 11)) AS i FROM d WHERE len(w) >= 13)
), f AS (
  SELECT t, min(doc_id) AS first FROM x GROUP BY t HAVING min(doc_id) < max(doc_id)
), gone AS (
  SELECT DISTINCT doc_id, unnest(range(i, i + 13)) AS p FROM x JOIN f USING (t) WHERE first < doc_id
), g AS (
  SELECT doc_id, list(p) AS ps FROM gone GROUP BY doc_id
), k AS (
  SELECT d.doc_id, len(w) AS n, coalesce(len(ps), 0) AS r, CASE WHEN ps IS NULL THEN w ELSE list_transform(list_filter(range(1, len(w) + 1), lambda i: NOT list_contains(ps, i)), lambda i: w[i]) END AS left_
  FROM d LEFT JOIN g USING (doc_id)
)
SELECT doc_id, CAST(n AS BIGINT) AS n_words, CAST(r AS BIGINT) AS n_removed, sha256(coalesce(array_to_string(left_, ' '), '')) AS kept_sha256 FROM k
"""
