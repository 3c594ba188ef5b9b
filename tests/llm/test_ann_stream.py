"""The queries of a shard are answered while they come, not held together."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

from lodestar.llm.ann import BATCH, _build, _search


def test_queries_are_answered_as_they_come():
    rng = np.random.default_rng(5)
    vectors = rng.normal(size=(300, 8)).astype(np.float32)
    shards = []
    for shard in (0, 1):
        ids = pa.array([[i] for i in range(shard, 300, 2)], pa.list_(pa.int64()))
        rows = pa.table({"first_id": np.arange(shard, 300, 2), "ids": ids, "vector": pa.array(vectors[shard::2].tolist(), pa.list_(pa.float32()))})
        shards.append(_build((pa.scalar(8), pa.scalar(shard)), rows))
    read = []

    def rows_of(shard):
        index = shards[shard]
        n = len(index)
        yield index.append_column("asked", pa.array(np.zeros(n, np.int32))).append_column("query_id", pa.nulls(n, pa.int64())).append_column(
            "query", pa.nulls(n, pa.list_(pa.float32()))
        )
        for at in range(0, 100 * BATCH, BATCH):
            read.append(at)
            q = (np.arange(at, at + BATCH)) % 300
            yield pa.table(
                {
                    "dim": pa.array(np.full(BATCH, 8, np.int32)), "shard": pa.array(np.full(BATCH, shard)), "node": pa.nulls(BATCH, pa.int32()),
                    "entry": pa.nulls(BATCH, pa.int32()), "ids": pa.nulls(BATCH, index.schema.field("ids").type),
                    "vector": pa.nulls(BATCH, index.schema.field("vector").type), "links": pa.nulls(BATCH, index.schema.field("links").type),
                    "asked": pa.array(np.ones(BATCH, np.int32)), "query_id": pa.array(q.astype(np.int64)),
                    "query": pa.array(vectors[q].tolist(), pa.list_(pa.float32())),
                }
            )

    def batches():
        for shard in (0, 1):
            for part in rows_of(shard):
                yield from part.to_batches()

    answers = _search(5, 96)(batches())
    for k in range(200):
        got = next(answers)
        assert len(read) == k + 1 and got.num_rows == 5 * BATCH
        assert {i % 2 for i in got.column("vec_id").to_pylist()} == {k // 100}
    assert next(answers, None) is None
