"""op8: what a worker holds does not grow with the rows of a batch or the texts of a shard."""

import tracemalloc

import numpy as np
import pyarrow as pa

from terraflux.llm import quality

TEXT = " ".join(f"word{i}" for i in range(600))


def peak(run):
    tracemalloc.start()
    run()
    top = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    return top


def test_scoring_holds_no_batch_as_strings():
    batch = pa.RecordBatch.from_pydict({"doc_id": range(6_000), "text": [f"{i} {TEXT}" for i in range(6_000)]})
    w = np.zeros(1 << quality.BITS, np.float32)
    assert batch.nbytes > 25e6
    assert peak(lambda: list(quality._scores(iter([batch]), w, 0.0))) < 25e6


def test_training_holds_distinct_slots_only():
    slots = np.repeat(np.arange(20_000, dtype=np.int32), 3)
    once = peak(lambda: quality.train([(slots, 1)], 1))
    assert peak(lambda: quality.train(((slots.copy(), i % 2) for i in range(100)), 1)) - once < 100 * 20_000 * 10


def test_a_text_goes_to_the_worker_once(spark):
    docs = spark.createDataFrame([(1, "a calm day", 5, "x"), (2, None, None, "y"), (3, "BUY $$$ now", 7, None)], "doc_id long, Text string, score int, row string")
    labels = spark.createDataFrame([(1, 1), (3, 0)], "doc_id long, quality int")
    kept = quality.drop_low_quality(docs, labels)
    assert kept.columns == docs.columns and set(kept.collect()) <= set(docs.collect()) and kept.count() > 0
    plan = kept._jdf.queryExecution().analyzed().toString()
    given = next(x for x in plan.splitlines()[plan.splitlines().index(next(x for x in plan.splitlines() if "MapInArrow" in x)) + 1 :] if "Project" in x)
    assert given.count("Text#") == 1 and "text#" not in given
