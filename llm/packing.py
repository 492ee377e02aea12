"""Best-fit packing of documents into sequences of fixed length, without conflicts within a sequence.

Rows are dealt to shards by hash, or by ranges of a given order, and each shard is packed on its own, so
shards and not documents meet in a task. A bin carries one bitmap of the sources and one of the duplicate clusters it holds; a document
may not join a bin that holds its source or its cluster. Bins are kept in order of what is left in them,
and the search goes from the first bin that is large enough to its successors until one is compatible.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from llm.shared import squeezed, words

CAPACITY = 2048
SHARD_ROWS = 4096
_COLUMNS = "doc_id long, piece int, start long, length int, shard long, bin int, place int"


def _bits(values: np.ndarray, shared_only: bool) -> list[int]:
    """One bit for each distinct value; with shared_only none for values that occur once."""
    _, index, count = np.unique(values, return_inverse=True, return_counts=True)
    rank = np.cumsum(count > 1) - 1 if shared_only else np.arange(len(count))
    return [0 if shared_only and count[i] < 2 else 1 << int(rank[i]) for i in index]


def best_fit(lengths: np.ndarray, sources: np.ndarray, clusters: np.ndarray, capacity: int = CAPACITY) -> np.ndarray:
    """The bin of each item, longest items first (ties in the given order); lengths are at most capacity."""
    source_bit, cluster_bit = _bits(sources, False), _bits(clusters, True)
    left: list[tuple[int, int]] = []
    held_sources: list[int] = []
    held_clusters: list[int] = []
    out = np.empty(len(lengths), np.int64)
    for item in np.argsort(-np.asarray(lengths), kind="stable").tolist():
        length, source, cluster = int(lengths[item]), source_bit[item], cluster_bit[item]
        at = bisect_left(left, (length, -1))
        while at < len(left) and (held_sources[left[at][1]] & source or held_clusters[left[at][1]] & cluster):
            at += 1
        if at < len(left):
            room, chosen = left.pop(at)
            held_sources[chosen] |= source
            held_clusters[chosen] |= cluster
        else:
            room, chosen = capacity, len(held_sources)
            held_sources.append(source)
            held_clusters.append(cluster)
        if room > length:
            insort(left, (room - length, chosen))
        out[item] = chosen
    return out


def _packer(capacity: int, ordered: bool):
    def pack(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        ties = ["position", "piece"] if ordered else ["doc_id", "cluster", "piece"]
        rows = rows.sort_values(["length", *ties], ascending=[False] + [True] * len(ties), kind="stable")
        rows["bin"] = best_fit(rows["length"].to_numpy(), rows["source"].to_numpy(), rows["cluster"].to_numpy(), capacity)
        if ordered:
            rows = rows.sort_values(ties, kind="stable")
            rows["bin"] = pd.factorize(rows["bin"])[0]
            rows = rows.sort_values(["bin", *ties], kind="stable")
        rows["place"] = rows.groupby("bin").cumcount()
        rows["start"] = rows["piece"].astype("int64") * capacity
        rows["shard"] = key[0]
        return rows[[c.split()[0] for c in _COLUMNS.split(", ")]]

    return pack


def packed(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    source: str = "source",
    cluster: str | None = None,
    capacity: int = CAPACITY,
    shard_rows: int = SHARD_ROWS,
    position: Callable[[DataFrame], DataFrame] | None = None,
) -> DataFrame:
    """One row per piece of a document: doc_id, piece, start, length, shard, bin, place in the bin.

    Length is in words. A document of more words than a bin holds is cut into full pieces and a rest; a
    null or empty text is one piece of length 0. cluster is a column with the duplicate cluster; without
    it equal texts (but for white space) form one. A null source or cluster is a value like any other.
    Only ids, lengths and hashes are shuffled; a shard has about shard_rows pieces, and the number of
    shards grows with the rows.

    position gives rows with columns doc_id and from (the source) as _row with a distinct position from 0
    on. Then a shard is shard_rows documents that follow each other, whatever their pieces, and its bins
    and what they hold come in that order.
    """
    key = F.xxhash64(F.lit("c"), F.col(f"`{cluster}`")) if cluster else F.xxhash64(squeezed(F.col(f"`{text}`")))
    items = docs.select(
        F.col(f"`{doc_id}`").cast("long").alias("doc_id"),
        F.xxhash64(F.lit("s"), F.col(f"`{source}`")).alias("source"),
        key.alias("cluster"),
        F.size(words(F.col(f"`{text}`"))).alias("words"),
        F.col(f"`{source}`").alias("from"),
    )
    if position:
        items = position(items).select("_row.*", "position")
    pieces = F.greatest(F.ceil(F.col("words") / capacity).cast("int"), F.lit(1))
    items = items.withColumn("piece", F.explode(F.sequence(F.lit(0), pieces - 1)))
    length = F.least(F.lit(capacity), F.col("words") - F.col("piece") * capacity)
    items = items.withColumn("length", length).drop("words")
    if position:
        shard = F.floor(F.col("position") / shard_rows).alias("shard")
        return items.drop("from").withColumn("shard", shard).groupBy("shard").applyInPandas(_packer(capacity, True), _COLUMNS)
    rows = docs.count()
    shard = F.pmod(F.xxhash64("doc_id", "cluster", "piece"), F.lit(rows // shard_rows + 1)).alias("shard")
    return items.drop("from").withColumn("shard", shard).groupBy("shard").applyInPandas(_packer(capacity, False), _COLUMNS)
