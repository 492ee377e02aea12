import hashlib
import re

import pytest
from pyspark.sql import functions as F

from llm import exact

ROWS = [
    (1, "a b"), (2, "ab"), (3, "a  b\n"), (4, None), (5, ""), (6, " \t"), (7, "Ab"), (8, "ab "), (9, "a b"), (10, "x" * 50_000),
    (11, "x" * 50_000), (None, "a  b\n"), (None, "lone"), (12, "c d"), (12, "c d"), *[(100 + i, f"text {i % 40}") for i in range(120)],
]


def plain(text):
    return re.sub(r"[\x20\x09-\x0D]", "", text or "")


def want(rows):
    groups = {}
    for i, t in rows:
        groups.setdefault(plain(t), []).append((len(t or ""), i))
    best = {k: max(v, key=lambda x: (x[0], x[1] is not None, -(x[1] or 0))) for k, v in groups.items()}
    return sorted(
        (str(i), str(best[plain(t)][1]), len(groups[plain(t)]), (len(t or ""), i) == best[plain(t)], hashlib.sha256(plain(t).encode()).hexdigest())
        for i, t in rows
    )


@pytest.mark.parametrize("key_bits, capacity, depth", [(64, 100_000, 12), (2, 5, 3), (1, 1, 6)])
def test_groups_equal_plain_grouping(docs, key_bits, capacity, depth):
    frame = docs(ROWS)
    index = exact.build_index(frame, capacity=capacity, depth=depth, key_bits=key_bits)
    found = exact.looked_up(frame, index, key_bits=key_bits)
    got = [(str(r._id), str(r.keep_id), r.group_size, r.kept, r.text_sha256) for r in found.drop("_row").collect()]
    assert sorted(got) == want(ROWS)
    if key_bits < 3:  # different texts share keys and are chained
        assert index.agg(F.max("chain")).first()[0] > 0
        assert index.groupBy("key", "chain").count().filter("count > 1").count() == 0


def test_directory_splits_overfull_buckets(spark):
    keys = spark.range(1000).select(F.xxhash64("id").alias("key")).union(spark.range(500).select(F.lit(5).cast("long")))
    cells = {r.address: r for r in exact.directory(keys, capacity=100, depth=8).collect()}
    held = {}
    for r in keys.collect():
        cell = (r.key % 2**64) >> 56
        held.setdefault((cells[cell].bucket, cells[cell].local_depth), []).append(cell)
    assert all(len(v) <= 100 or depth == 8 for (_, depth), v in held.items())
    assert max(depth for _, depth in held) == 8 and min(depth for _, depth in held) < 8
    for (bucket, depth), v in held.items():
        assert all(cell >> (8 - depth) == bucket >> (8 - depth) for cell in v)


def test_one_row_of_each_text_stays(docs, rows):
    frame = docs(ROWS).withColumn("key", F.lit("mine")).withColumn("bucket", F.lit(1))
    kept = exact.deduplicated(frame)
    assert kept.columns == frame.columns
    texts = [plain(r.text) for r in kept.collect()]
    assert len(texts) == len(set(texts)) == len({plain(t) for _, t in ROWS})
    assert {(r.doc_id, r.key) for r in kept.filter("doc_id < 20").collect()} == {(i, "mine") for i in (3, 6, 7, 9, 10, 12)}
    assert exact.deduplicated(docs([])).count() == 0
