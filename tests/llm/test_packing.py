import numpy as np
import pytest
from pyspark.sql import functions as F

from llm import packing


@pytest.mark.parametrize("seed", range(5))
def test_every_item_gets_the_tightest_compatible_bin(seed):
    rng = np.random.default_rng(seed)
    n = 300
    lengths, sources, clusters = rng.integers(0, 101, n), rng.integers(0, 6, n), rng.integers(0, 200, n)
    sources[rng.random(n) < 0.4] = 0
    got = packing.best_fit(lengths, sources, clusters, 100)
    bins = []
    for i in np.argsort(-lengths, kind="stable"):
        fits = [
            (b["left"], k) for k, b in enumerate(bins)
            if b["left"] > 0 and b["left"] >= lengths[i] and sources[i] not in b["s"] and clusters[i] not in b["c"]
        ]
        k = min(fits)[1] if fits else len(bins)
        if not fits:
            bins.append({"left": 100, "s": set(), "c": set()})
        bins[k]["left"] -= lengths[i]
        bins[k]["s"].add(sources[i])
        bins[k]["c"].add(clusters[i])
        assert got[i] == k
    assert all(b["left"] >= 0 for b in bins)


def test_nothing_is_lost_and_nothing_conflicts(docs):
    pairs = [(i, " ".join(f"w{i}.{k}" for k in range(i % 23))) for i in range(200)]
    pairs += [(500, None), (501, ""), (502, "x " * 105), (503, "same text"), (504, "same  text"), (None, "no id"), (505, "twice"), (505, "twice")]
    frame = docs(pairs, ["a", "a", "b", "c", None]).withColumn("bin", F.lit("mine")).withColumn("length", F.lit(3))
    found = packing.packed(frame, capacity=20, shard_rows=64).collect()
    lengths, bins, source = {}, {}, {}
    for n, (i, t) in enumerate(pairs):
        lengths[i] = lengths.get(i, 0) + len((t or "").split())
        source[i] = ["a", "a", "b", "c", None][n % 5]
    for r in found:
        lengths[r.doc_id] -= r.length
        bins.setdefault((r.shard, r.bin), []).append(r)
        assert r.start == r.piece * 20 and 0 <= r.length <= 20
    assert set(lengths.values()) == {0} and len(found) == len(pairs) + 5 + sum(len((t or "").split()) == 0 for _, t in []) + sum(i % 23 > 20 for i in range(200))
    for items in bins.values():
        assert sum(r.length for r in items) <= 20
        assert sorted(r.place for r in items) == list(range(len(items)))
        named = [source[r.doc_id] for r in items if r.doc_id != 505]
        assert len(named) == len(set(named))
        assert not {503, 504} <= {r.doc_id for r in items}
    assert [(r.piece, r.length) for r in sorted((r for r in found if r.doc_id == 502), key=lambda r: r.piece)] == [(k, 20) for k in range(5)] + [(5, 5)]


def test_given_clusters_and_no_rows(docs):
    frame = docs([(i, f"t{i}") for i in range(6)], list("abcdef")).withColumn("group", F.lit("g"))
    assert len({(r.shard, r.bin) for r in packing.packed(frame, cluster="group", capacity=50).collect()}) == 6
    assert len({(r.shard, r.bin) for r in packing.packed(frame, capacity=50).collect()}) == 1
    assert packing.packed(docs([])).count() == 0
