"""Near-duplicate vectors by sorted projection passes.

Each pass draws its own random hyperplanes; the signs of a vector's projections, concatenated, form a
64-bit key whose leading bits are its most significant. Ordered by (label, key), vectors that point the
same way sit close to each other, so every vector is compared with the WINDOW vectors after it, exactly,
by cosine in double precision. All passes are one range-partitioned sort: each task compares the rows of
its own range, and the first and last WINDOW rows of every range (at most 2 * WINDOW * partitions rows,
whatever the input size) are sorted once more and compared across the seams. Verified pairs of all passes
are united; components come from the star rounds of `llm.graph`.

Defined cases: a vector that is null, empty, zero, or holds a null or non-finite component, or whose label
is null, links with nothing (n_links 0, its own component). Vectors of different lengths never link.
Rows that repeat a vec_id are each compared, but an id never links with itself; every such row gets the
id's figures. A row with a null vec_id links with nothing: n_links 0, component_id null, kept true. Equal
vectors link (cosine 1). Other columns of the input are ignored.
A group of thousands of equal vectors is not all pairs: each member links with its window, and the
chain joins them into one component.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from llm.graph import components
from llm.shared import stored

PASSES = 8
WINDOW = 12
THRESHOLD = 0.98
SEED = 1_202_2026
_BITS = 64
_KEYED = "vec_id long, label long, dim int, raw binary, keys array<long>"
_SORTED = ("pass", "label", "key", "vec_id")
_FOUND = "kind int, a long, b long, pass int, label long, key long, vec_id long, dim int, raw binary"
_PAIR, _EDGE = 0, 1


@lru_cache(maxsize=16)
def _planes(dim: int) -> np.ndarray:
    """PASSES x 64 random hyperplanes of a length, the same in every task."""
    return np.random.default_rng([SEED, dim]).standard_normal((PASSES, _BITS, dim))


def _keys(vectors: np.ndarray) -> np.ndarray:
    """Sign bits of each pass, the first plane most significant, as longs that order like the bits."""
    signs = np.einsum("nd,pbd->npb", vectors, _planes(vectors.shape[1])) >= 0
    weights = np.left_shift(np.uint64(1), np.arange(_BITS - 1, -1, -1, dtype=np.uint64))
    packed = (signs.astype(np.uint64) * weights).sum(axis=2, dtype=np.uint64)
    return (packed ^ np.uint64(1 << 63)).view(np.int64)


def _keyed(batches: Iterator[pd.DataFrame], dtype: str) -> Iterator[pd.DataFrame]:
    for batch in batches:
        ids, labels, dims, raws, keys = [], [], [], [], []
        by_dim: dict[int, list] = {}
        for vid, label, vector in zip(batch.vec_id, batch.label, batch.embedding):
            if pd.isna(vid) or pd.isna(label) or vector is None or len(vector) == 0:
                continue
            values = np.array(vector, dtype=np.float64)
            if not np.isfinite(values).all() or not values.any():
                continue
            by_dim.setdefault(len(values), []).append((int(vid), int(label), values))
        for dim, rows in by_dim.items():
            matrix = np.stack([r[2] for r in rows])
            found = _keys(matrix / np.linalg.norm(matrix, axis=1, keepdims=True))
            for (vid, label, values), key in zip(rows, found):
                ids.append(vid)
                labels.append(label)
                dims.append(dim)
                raws.append(values.astype(dtype).tobytes())
                keys.append(key.tolist())
        if ids:
            yield pd.DataFrame({"vec_id": ids, "label": labels, "dim": dims, "raw": raws, "keys": keys})


def _window_pairs(frame: pd.DataFrame, dtype: str, window: int, threshold: float, first: int = 1) -> pd.DataFrame:
    """Pairs (a, b) of rows at most window apart in frame's order, the later at position first or after,
    of the same pass, label and length, with cosine >= threshold."""
    n = len(frame)
    if n < 2:
        return pd.DataFrame({"a": [], "b": []}, dtype="int64")
    dims = frame.dim.to_numpy()
    matrix = np.zeros((n, int(dims.max())))
    for i, raw in enumerate(frame.raw):
        values = np.frombuffer(raw, dtype=dtype).astype(np.float64)
        matrix[i, : len(values)] = values
    unit = matrix / np.linalg.norm(matrix, axis=1, keepdims=True)
    ids, passes, labels = frame.vec_id.to_numpy(), frame["pass"].to_numpy(), frame.label.to_numpy()
    a, b = [], []
    for off in range(1, min(window, n - 1) + 1):
        same = (passes[:-off] == passes[off:]) & (labels[:-off] == labels[off:]) & (dims[:-off] == dims[off:])
        same &= (ids[:-off] != ids[off:]) & (np.arange(off, n) >= first)
        at = np.nonzero(same)[0]
        if len(at):
            cosine = np.einsum("nd,nd->n", unit[at], unit[at + off])
            hit = at[cosine >= threshold]
            a.append(ids[hit])
            b.append(ids[hit + off])
    if not a:
        return pd.DataFrame({"a": [], "b": []}, dtype="int64")
    a, b = np.concatenate(a), np.concatenate(b)
    return pd.DataFrame({"a": np.minimum(a, b), "b": np.maximum(a, b)})


def _compared(batches: Iterator[pd.DataFrame], dtype: str, window: int, threshold: float, seams: bool) -> Iterator[pd.DataFrame]:
    """One sorted range, batch by batch with the last window rows carried over: its verified pairs, and
    (seams) its first and last window rows. Memory holds one batch and the carry."""
    columns = ("pass", "label", "key", "vec_id", "dim", "raw")
    carry, head = None, None
    for batch in batches:
        if batch.empty:
            continue
        frame = batch if carry is None else pd.concat([carry, batch], ignore_index=True)
        start = 0 if carry is None else len(carry)
        pairs = _window_pairs(frame.reset_index(drop=True), dtype, window, threshold, max(start, 1))
        if len(pairs):
            yield pd.DataFrame({"kind": _PAIR, "a": pairs.a, "b": pairs.b, **{c: None for c in columns}}).astype({"kind": "int32"})
        if head is None or len(head) < window:
            head = frame.iloc[:window] if head is None else pd.concat([head, batch.iloc[: window - len(head)]], ignore_index=True)
        carry = frame.iloc[-window:].reset_index(drop=True)
    if seams and carry is not None:
        edge = pd.concat([head, carry], ignore_index=True).drop_duplicates(list(_SORTED) + ["raw"])
        edge = edge.sort_values(list(_SORTED), kind="stable")
        yield pd.DataFrame({"kind": _EDGE, "a": None, "b": None, **{c: edge[c].to_numpy() for c in columns}}).astype({"kind": "int32"})


def vector_links(vectors: DataFrame, passes: int = PASSES, window: int = WINDOW, threshold: float = THRESHOLD) -> DataFrame:
    """Distinct pairs (a < b) of vec_ids whose vectors have equal, non-null labels and cosine >= threshold,
    as found by the sorted passes (none below the threshold)."""
    element = vectors.schema["embedding"].dataType.elementType
    dtype = "<f4" if isinstance(element, T.FloatType) else "<f8"
    rows = vectors.select(F.col("vec_id").cast("long"), F.col("label").cast("long"), "embedding")
    keyed = stored(rows.mapInPandas(lambda it: _keyed(it, dtype), _KEYED), "vectors")
    dealt = keyed.select(F.posexplode(F.slice("keys", 1, passes)).alias("pass", "key"), "label", "vec_id", "dim", "raw")
    ranged = dealt.repartitionByRange(*_SORTED).sortWithinPartitions(*_SORTED)
    found = stored(ranged.mapInPandas(lambda it: _compared(it, dtype, window, threshold, True), _FOUND), "vector-pairs")
    seams = found.filter(F.col("kind") == _EDGE).select(*_SORTED, "dim", "raw").repartition(1).sortWithinPartitions(*_SORTED)
    stitched = seams.mapInPandas(lambda it: _compared(it, dtype, window, threshold, False), _FOUND)
    pairs = found.filter(F.col("kind") == _PAIR).select("a", "b").union(stitched.select("a", "b"))
    return pairs.distinct()


def near_duplicate_vectors(vectors: DataFrame, passes: int = PASSES, window: int = WINDOW, threshold: float = THRESHOLD) -> DataFrame:
    """vec_id, n_links (vectors linked directly), component_id (least vec_id reachable), kept (vec_id = component_id)
    for every row of vectors (vec_id, embedding, label)."""
    links = stored(vector_links(vectors, passes, window, threshold), "vector-links")
    degree = links.select(F.col("a").alias("vec_id")).union(links.select("b")).groupBy("vec_id").agg(F.count(F.lit(1)).alias("n_links"))
    roots = components(links).select(F.col("node").alias("vec_id"), F.col("root").alias("component_id"))
    ids = vectors.select(F.col("vec_id").cast("long"))
    out = ids.join(degree, "vec_id", "left").join(roots, "vec_id", "left")
    component = F.coalesce("component_id", "vec_id")
    return out.select(
        "vec_id",
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"),
        F.coalesce(F.col("vec_id") == component, F.lit(True)).alias("kept"),
    )
