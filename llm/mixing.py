"""Interleaving sources in target proportions by Pfair scheduling.

The rows of a source form blocks. With weights of q_s / A, the i-th block of a source is released at
slot floor((i - 1) * A / q_s) and due at ceil(i * A / q_s); earliest deadline first over released blocks
keeps every source within less than one block of its share at every slot. By default A is so large that
the quotas are the weights to within 2^-62, and the driver deals all blocks once, without holding them;
rows look their block's slot up. With a resolution A is about that many slots and repeats, so every row
finds its slot by arithmetic, but the bound holds against the rounded quotas only. When a source runs
out, the others go on with their weights scaled up: a new phase.
"""

from __future__ import annotations

import json
from collections.abc import Iterator, Mapping
from dataclasses import asdict, dataclass
from fractions import Fraction
from heapq import heapify, heappop, heappush
from itertools import islice

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from llm.shared import shared_path

BLOCK_ROWS = 64
RESOLUTION = 1000
BUCKET_ROWS = 20_000
CHUNK_BLOCKS = 256
_EXACT = 1 << 62
_CHUNKS_AT_ONCE = 400
_CHUNK = "struct<source string, chunk bigint, slots array<bigint>>"
_LEG = "struct<source string, first bigint, last bigint, start bigint, period bigint, quota bigint, slots array<bigint>>"


def quotas(weights: Mapping[str, float], resolution: int = RESOLUTION) -> dict[str, int]:
    """Whole quotas of about resolution slots in all; every source with a weight gets one slot at least."""
    total = sum(weights.values())
    return {s: max(1, round(w * resolution / total)) for s, w in sorted(weights.items())}


def period_slots(quota: Mapping[str, int]) -> dict[str, list[int]]:
    """The slots of one period that each source gets, earliest deadline first among released blocks."""
    period, given = sum(quota.values()), {s: [] for s in quota}
    for slot in range(period):
        released = [s for s, q in quota.items() if len(given[s]) < q and len(given[s]) * period // q <= slot]
        chosen = min(released, key=lambda s: (-(-(len(given[s]) + 1) * period // quota[s]), s))
        given[chosen].append(slot)
    return given


@dataclass(frozen=True)
class Leg:
    """Blocks first..last-1 of a source: slot = start + (n // quota) * period + slots[n % quota], n from first."""

    source: str
    first: int
    last: int
    start: int
    period: int
    quota: int
    slots: list[int]


def schedule(weights: Mapping[str, float], blocks: Mapping[str, int], resolution: int = RESOLUTION) -> list[Leg]:
    """Legs that place every block of every source that has a weight; works on one number per source."""
    left = {s: n for s, n in blocks.items() if n and s in weights}
    done, start, legs = dict.fromkeys(left, 0), 0, []
    while left:
        quota = quotas({s: weights[s] for s in left}, resolution)
        period, slots = sum(quota.values()), period_slots(quota)
        last = {s: (n - 1) // quota[s] * period + slots[s][(n - 1) % quota[s]] for s, n in left.items()}
        length = min(last.values()) + 1
        for s in list(left):
            whole, rest = divmod(length, period)
            n = min(left[s], whole * quota[s] + sum(x < rest for x in slots[s]))
            if n:
                legs.append(Leg(s, done[s], done[s] + n, start, period, quota[s], slots[s]))
            done[s] += n
            left[s] -= n
            if not left[s]:
                del left[s]
        start += length
    return legs


def exact_order(weights: Mapping[str, float], blocks: Mapping[str, int]) -> Iterator[str]:
    """The source of every slot, by the weights themselves; every block of a source that has a weight comes once."""
    left = {s: n for s, n in blocks.items() if n and s in weights}
    while left:
        total = sum(Fraction(weights[s]) for s in left)
        quota = {s: max(1, round(Fraction(weights[s]) * _EXACT / total)) for s in sorted(left)}
        period, given = sum(quota.values()), dict.fromkeys(left, 0)
        ready, later = [(-(-period // q), s) for s, q in quota.items()], []
        heapify(ready)
        for slot in range(sum(left.values())):
            while later and later[0][0] <= slot:
                s = heappop(later)[1]
                heappush(ready, (-(-(given[s] + 1) * period // quota[s]), s))
            s = heappop(ready)[1]
            yield s
            given[s] += 1
            if given[s] == left[s]:
                break
            heappush(later, (given[s] * period // quota[s], s))
        left = {s: n - given[s] for s, n in left.items() if n > given[s]}


def slot_chunks(weights: Mapping[str, float], blocks: Mapping[str, int], size: int = CHUNK_BLOCKS) -> Iterator[dict]:
    """exact_order() as the slots of blocks chunk * size and on of a source; holds one chunk a source."""
    held: dict[str, list[int]] = {}
    chunk = dict.fromkeys(blocks, 0)
    for slot, s in enumerate(exact_order(weights, blocks)):
        own = held.setdefault(s, [])
        own.append(slot)
        if len(own) == size:
            yield {"source": s, "chunk": chunk[s], "slots": held.pop(s)}
            chunk[s] += 1
    for s, own in held.items():
        yield {"source": s, "chunk": chunk[s], "slots": own}


def _stored_chunks(spark: SparkSession, chunks: Iterator[dict]) -> DataFrame:
    path = shared_path(spark, "slots")
    some = list(islice(chunks, _CHUNKS_AT_ONCE))
    while True:
        rows = spark.range(1).select(F.explode(F.from_json(F.lit(json.dumps(some)), f"array<{_CHUNK}>")).alias("c"))
        rows.select("c.*").write.mode("append").parquet(path)
        if not (some := list(islice(chunks, _CHUNKS_AT_ONCE))):
            return spark.read.schema("source string, chunk bigint, slots array<bigint>").parquet(path)


def row_counts(docs: DataFrame, source: str = "source") -> dict[str, int]:
    """Rows of each source; a null source is named "". One row a source comes to the driver."""
    name = F.coalesce(F.col(f"`{source}`").cast("string"), F.lit(""))
    return {r["s"]: r["n"] for r in docs.groupBy(name.alias("s")).agg(F.count(F.lit(1)).alias("n")).collect()}


def balanced_weights(rows: Mapping[str, int], exponent: float = 0.5) -> dict[str, float]:
    """Target weights that soften the sizes of the sources, as sampling with a temperature does."""
    return {s: n**exponent for s, n in rows.items() if n}


def mixed(
    docs: DataFrame,
    weights: Mapping[str, float] | None = None,
    source: str = "source",
    doc_id: str = "doc_id",
    block_rows: int = BLOCK_ROWS,
    resolution: int | None = None,
    bucket_rows: int = BUCKET_ROWS,
) -> DataFrame:
    """docs as _row with _source, block (of its source), slot (of the mixture) and place in the block.

    No row is dropped or repeated. Sources are cut into hash buckets of about bucket_rows rows, ranked
    there and shifted by the sizes of the buckets before, so a source that holds a third of all rows is
    ranked by many tasks. Rows of the same id share a bucket. weights must name every source ("" for
    null); by default balanced_weights() of all rows. At every slot a source is less than a block away
    from its share by the weights, or by quotas() if a resolution is given.
    """
    rows = row_counts(docs, source)
    weights = balanced_weights(rows) if weights is None else weights
    if missing := set(rows) - set(weights):
        raise ValueError(f"no target weight for {sorted(missing)[:5]}")
    blocks, spark = {s: -(-n // block_rows) for s, n in rows.items()}, docs.sparkSession
    buckets = F.lit(json.dumps({s: -(-n // bucket_rows) for s, n in rows.items()}))
    buckets = F.from_json(buckets, "map<string, bigint>")

    out = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"))
    name = F.coalesce(F.col(f"_row.`{source}`").cast("string"), F.lit(""))
    out = out.withColumns({"_source": name, "_hash": F.xxhash64(F.col(f"_row.`{doc_id}`"))})
    out = out.withColumn("_bucket", F.pmod("_hash", F.element_at(buckets, F.col("_source"))))
    sizes = out.groupBy("_source", "_bucket").agg(F.count(F.lit(1)).alias("n"))
    before = W.partitionBy("_source").orderBy("_bucket").rowsBetween(W.unboundedPreceding, -1)
    sizes = sizes.select("_source", "_bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("_before"))
    rank = F.row_number().over(W.partitionBy("_source", "_bucket").orderBy("_hash", F.col(f"_row.`{doc_id}`"))) - 1
    out = out.withColumn("_rank", rank).join(sizes, ["_source", "_bucket"]).withColumn("_rank", F.col("_rank") + F.col("_before"))
    out = out.withColumn("block", F.floor(F.col("_rank") / block_rows))
    if resolution is None:
        chunk = F.floor(F.col("block") / CHUNK_BLOCKS)
        plan = _stored_chunks(spark, slot_chunks(weights, blocks))
        out = out.join(plan, (F.col("_source") == F.col("source")) & (chunk == F.col("chunk")))
        slot = F.get("slots", (F.col("block") - F.col("chunk") * CHUNK_BLOCKS).cast("int"))
    else:
        text = json.dumps([asdict(leg) for leg in schedule(weights, blocks, resolution)])
        plan = spark.range(1).select(F.explode(F.from_json(F.lit(text), f"array<{_LEG}>")).alias("leg")).select("leg.*")
        within = (F.col("block") >= F.col("first")) & (F.col("block") < F.col("last"))
        out = out.join(F.broadcast(plan), (F.col("_source") == F.col("source")) & within)
        n = F.col("block") - F.col("first")
        turn = F.floor(n / F.col("quota"))
        slot = F.col("start") + turn * F.col("period") + F.get("slots", (n - turn * F.col("quota")).cast("int"))
    return out.select("_row", "_source", "block", slot.alias("slot"), (F.col("_rank") - F.col("block") * block_rows).alias("place"))


def in_order(docs: DataFrame, **options) -> DataFrame:
    """The rows of docs in the order of the mixture, range-partitioned: part files follow each other."""
    return mixed(docs, **options).orderBy("slot", "place").select("_row.*")
