import random

import pytest
from pyspark.sql import functions as F

from llm import mixing


@pytest.mark.parametrize("seed", range(6))
def test_schedule_stays_within_a_block_of_the_shares(seed):
    rng = random.Random(seed)
    weights = {f"s{i}": rng.random() ** 3 + 0.001 for i in range(rng.randrange(1, 12))}
    blocks = {s: rng.randrange(0, 400) for s in weights}
    slots = {}
    for leg in mixing.schedule(weights, blocks, 200):
        for block in range(leg.first, leg.last):
            n = block - leg.first
            slot = leg.start + n // leg.quota * leg.period + leg.slots[n % leg.quota]
            assert slot not in slots
            slots[slot] = (leg.source, block)
    assert sorted(slots) == list(range(sum(blocks.values())))
    assert sorted(slots.values()) == sorted((s, i) for s, n in blocks.items() for i in range(n))
    done, left, given, start = dict.fromkeys(blocks, 0), {s: n for s, n in blocks.items() if n}, {}, 0
    quota = mixing.quotas({s: weights[s] for s in left}, 200) if left else {}
    for slot in range(len(slots)):
        source, block = slots[slot]
        assert block == done[source]
        done[source] += 1
        given[source] = given.get(source, 0) + 1
        period = sum(quota.values())
        for s in quota:
            assert abs(given.get(s, 0) - (slot - start + 1) * quota[s] / period) < 1
        left[source] -= 1
        if not left[source]:
            del left[source]
            given, start = {}, slot + 1
            quota = mixing.quotas({s: weights[s] for s in left}, 200) if left else {}


def test_every_row_gets_one_place(docs):
    pairs = [(i, f"t{i}") for i in range(500)] + [(None, "x"), (None, "y"), (3, "t3"), (3, "t3")]
    frame = docs(pairs, ["a", "a", "a", "b", None, "c d"]).withColumn("slot", F.lit("mine")).withColumn("first", F.lit(1))
    found = mixing.mixed(frame, block_rows=7, resolution=50, bucket_rows=30).collect()
    assert len(found) == len(pairs) and sorted(str(r._row.doc_id) for r in found) == sorted(str(i) for i, _ in pairs)
    assert {r._row.slot for r in found} == {"mine"}
    places, blocks = {}, {}
    for r in found:
        assert r._source == (r._row.source or "")
        assert (r.slot, r.place) not in places and 0 <= r.place < 7
        places[r.slot, r.place] = r
        assert blocks.setdefault((r._source, r.block), r.slot) == r.slot
    assert sorted(blocks.values()) == list(range(len(blocks)))
    counts = {}
    for r in found:
        counts[r._source, r.block] = counts.get((r._source, r.block), 0) + 1
    for source in {s for s, _ in counts}:
        sizes = [n for (s, b), n in sorted(counts.items()) if s == source]
        assert all(n == 7 for n in sizes[:-1]) and 1 <= sizes[-1] <= 7


def test_given_weights(docs, rows):
    frame = docs([(i, "t") for i in range(90)], ["a", "b", "c"])
    ordered = mixing.in_order(frame, weights={"a": 2, "b": 1, "c": 1}, block_rows=5, resolution=4).collect()
    assert [r.source for r in ordered][::5][:8] == ["a", "b", "a", "c"] * 2
    with pytest.raises(ValueError, match="no target weight"):
        mixing.mixed(frame, weights={"a": 1})
    assert mixing.in_order(docs([])).count() == 0


@pytest.mark.parametrize("seed", range(4))
def test_slots_stay_within_a_block_of_the_target_weights(seed):
    rng = random.Random(seed)
    weights = {f"s{i}": rng.random() ** 3 + 0.001 for i in range(2 + 3 * seed)} | {"rare": 0.0001, "root": 12345**0.5 / 100}
    blocks = {s: int(40_000 * w) + 1 for s, w in weights.items()}
    left, given, start = dict(blocks), dict.fromkeys(blocks, 0), 0
    for slot, source in enumerate(mixing.exact_order(weights, blocks)):
        given[source] += 1
        total = sum(weights[s] for s in left)
        if slot < 500 or slot % 97 == 0:
            assert all(abs(given[s] - (slot - start + 1) * weights[s] / total) < 1 + 1e-6 for s in left)
        if given[source] == left[source]:
            left = {s: n - given[s] for s, n in left.items() if n > given[s]}
            given, start = dict.fromkeys(left, 0), slot + 1
    assert not left


def test_rows_follow_the_target_weights(docs):
    frame = docs([(i, "t") for i in range(900)], ["a", "b", "b"])
    found = mixing.mixed(frame, weights={"a": 1, "b": 5000}, block_rows=1).collect()
    assert sorted(r.slot for r in found) == list(range(900))
    assert [r._source for r in sorted(found, key=lambda r: r.slot)].index("a") > 590
    order = list(mixing.exact_order({"a": 1, "b": 5000}, {"a": 300, "b": 600}))
    assert [r._source for r in sorted(found, key=lambda r: r.slot)] == order
