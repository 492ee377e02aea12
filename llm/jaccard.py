"""Exact self-join of documents on the Jaccard similarity of their five-word shingles.

Candidates come from partitioning the hashed universe. Sizes fall into bands, each with a number of
segments; a shingle's hash decides its segment. Two sets that link differ in at most H shingles, so of
the segments in which a set has shingles, all but H must be the same in the other set. Each set
therefore indexes H + 1 of its segment subsets in its own band and, where a larger partner may lie
there, in the next. The allocation is by cost: subsets of common shingles alone come last (a first pass
over the texts finds the common ones), and of the others those with most shingles first, since they are
the rarest; both sets of a pair rank a common subset alike. So a line that many texts share connects
only texts that consist of little else. A set with shingles in too few segments (only tiny ones) also
indexes half as many, larger segments with their one-deletion neighbourhoods: if each of H // 2 + 1
segments differed in two shingles, more than H would differ.

Sets that share an entry are candidates; only the connections are kept (a star for each entry, folded
in every task first), never the pairs. Entries and sets go to the stars as hashes of 40 bits: two that
meet by chance only make a group of candidates larger. Each connected group of candidates is then
joined exactly, small groups together in one task, large ones as pairs of blocks of bounded size. Only
the texts of candidates are dealt out for that. Equal sets are one class throughout.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from llm.graph import components
from llm.shared import arrow_batches, marked, shared_path, stored
from llm.shingles import arrow_bytes, mixed, shingle_sets

PERCENT = 80
BLOCK_SHINGLES = 1_000_000
_FLUSH = 1_000_000
_SLICE = 1_500_000
TEXT_ROWS = 400
#: Shingles counted at once, how often one occurs among them at least to be reported, and in all to be common; most common ones.
_COUNTED, _OFTEN, _COMMON_SETS, _COMMON = 2_000_000, 3, 16, 1 << 18
_META, _OFTEN_HERE = 0, 1
_DESCRIBED = "kind int, doc_id long, text_key long, n long, f1 long, f2 long"
_DESCRIBED_ARROW = pa.schema([("kind", pa.int32()), *[(c, pa.int64()) for c in ("doc_id", "text_key", "n", "f1", "f2")]])
#: A task's entries for one part with their nodes, or (a, b) edges among its own sets.
_SIGNED = "part int, entries binary, nodes binary, a binary, b binary"
_SIGNED_ARROW = pa.schema([("part", pa.int32()), *[(c, pa.binary()) for c in ("entries", "nodes", "a", "b")]])
_BYTES = 5
_NODE = (1 << 8 * _BYTES) - 1


def _bands(limit: int) -> np.ndarray:
    """Least size of each band, up to one above limit."""
    low = [1]
    while low[-1] <= 2 * limit + 2:
        low.append(low[-1] * 3 // 2 + 1)
    return np.array(low, np.int64)


def _difference(n, percent: int):
    """Most shingles in which a linked set of n or more shingles differs from one of n."""
    return 100 * n // percent - n


def _deletions(values: np.ndarray, high: int, band: int, percent: int) -> np.ndarray:
    """Entries of a tiny set: subsets of larger segments, and those without one of their shingles."""
    segments = int(_difference(high, percent)) // 2 + 1
    hashed = mixed(values, 5)
    segment = ((hashed >> np.uint64(32)) * np.uint64(segments)) >> np.uint64(32)
    out = []
    for s in range(segments):
        own = hashed[segment == np.uint64(s)]
        total = own.sum(dtype=np.uint64)
        tag = np.uint64((band * 1_000_003 + s * 7919 + 13) * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF)
        out.append(mixed(np.concatenate([[total], total - own]).astype(np.uint64) + tag, 7))
    return np.concatenate(out)


def _classes(values: np.ndarray, common: tuple[np.ndarray, np.ndarray] | None) -> np.ndarray:
    """How common each shingle is: 0 unless it is among common (sorted shingles, their classes)."""
    if common is None or not len(common[0]):
        return np.zeros(len(values), np.uint8)
    at = np.minimum(np.searchsorted(common[0], values), len(common[0]) - 1)
    return np.where(common[0][at] == values, common[1][at], 0).astype(np.uint8)


def index_entries(
    values: np.ndarray, offsets: np.ndarray, percent: int = PERCENT, common: tuple[np.ndarray, np.ndarray] | None = None
) -> tuple[np.ndarray, np.ndarray]:
    """Entries of the sets (entry, number of the set); a subset is as common as its least common shingle."""
    n = np.diff(offsets)
    if not len(values):
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    classes = _classes(values, common)
    low = _bands(int(n.max()))
    own_band = np.searchsorted(low, n, "right") - 1
    entries, owners = [], []
    for step in (0, 1):
        band = own_band + step
        use = np.flatnonzero((n > 0) & ((step == 0) | (100 * n // percent >= low[np.maximum(band, 0)])))
        if not len(use):
            continue
        size, band, differ = n[use], band[use], _difference(n[use], percent)
        high = low[band + 1] - 1
        segments = (_difference(high, percent) + 1) * 4 // 3 + 1
        total = int(size.sum())
        at = np.repeat(offsets[use] - np.concatenate([[0], np.cumsum(size)[:-1]]), size) + np.arange(total)
        own = np.repeat(np.arange(len(use)), size)
        shingle = values[at]
        segment = ((shingle >> np.uint64(32)) * segments[own].astype(np.uint64)) >> np.uint64(32)
        begin = np.ones(total, bool)
        begin[1:] = (segment[1:] != segment[:-1]) | (own[1:] != own[:-1])
        begin = np.flatnonzero(begin)
        held = np.diff(np.append(begin, total))
        subset = np.add.reduceat(mixed(shingle, 3), begin)
        owner = own[begin]
        place = segment[begin] + band[owner].astype(np.uint64) * np.uint64(0x100000001)
        entry = mixed(subset + mixed(place, 4), 6)
        # the least common first, then the most shingles: class and 255 - held in the leading bytes
        turn = np.minimum.reduceat(classes[at], begin).astype(np.uint64) << np.uint64(8) | np.uint64(255) - np.minimum(held, 255).astype(np.uint64)
        entry = turn << np.uint64(48) | entry >> np.uint64(16)
        filled = np.bincount(owner, minlength=len(use))
        first = np.concatenate([[0], np.cumsum(filled)])
        for i in np.flatnonzero(filled > 1):
            entry[first[i] : first[i + 1]].sort()
        chosen = np.arange(len(entry)) - first[owner] <= differ[owner]
        entries.append(entry[chosen])
        owners.append(use[owner[chosen]])
        for i in np.flatnonzero(filled <= differ):
            more = _deletions(values[offsets[use[i]] : offsets[use[i] + 1]], int(high[i]), int(band[i]), percent)
            entries.append(more)
            owners.append(np.full(len(more), use[i]))
    return np.concatenate(entries), np.concatenate(owners)


def _fold(entries: np.ndarray, nodes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """One entry and node of each entry value, and the star edges (node, its node) of the others."""
    order = np.argsort(entries)
    entries, nodes = entries[order], nodes[order]
    fresh = np.ones(len(entries), bool)
    fresh[1:] = entries[1:] != entries[:-1]
    hub = nodes[fresh][np.cumsum(fresh) - 1]
    other = hub != nodes
    edges = np.unique(np.stack([hub[other], nodes[other]], 1), axis=0) if other.any() else np.empty((0, 2), np.int64)
    return entries[fresh], nodes[fresh], edges[:, 0], edges[:, 1]


def _forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The edges as stars: each node but the least of its component, with that one."""
    names, index = np.unique(np.concatenate([a, b]), return_inverse=True)
    parent = list(range(len(names)))

    def find(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    half = len(a)
    for x, y in zip(index[:half].tolist(), index[half:].tolist()):
        x, y = find(x), find(y)
        if x != y:
            parent[max(x, y)] = min(x, y)
    root = np.array([find(x) for x in range(len(names))], np.int64)
    moved = root != np.arange(len(names))
    return names[moved], names[root[moved]]


def _batch(schema: pa.Schema, rows: int, **columns) -> pa.RecordBatch:
    arrays = [columns.get(f.name) for f in schema]
    arrays = [pa.nulls(rows, f.type) if a is None else a if isinstance(a, pa.Array) else pa.array(a, f.type) for a, f in zip(arrays, schema)]
    return pa.RecordBatch.from_arrays(arrays, schema=schema)


def _packed(numbers: np.ndarray) -> bytes:
    """The low 40 bits of each number."""
    return numbers.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :_BYTES].tobytes()


def _unpacked(data: bytes) -> np.ndarray:
    out = np.zeros((len(data) // _BYTES, 8), np.uint8)
    out[:, :_BYTES] = np.frombuffer(data, np.uint8).reshape(-1, _BYTES)
    return out.view("<u8").reshape(-1)


def _print(values: np.ndarray, offsets: np.ndarray, k: int) -> np.ndarray:
    """The k-th fingerprint (0 or 1) of each set; 0 for an empty one."""
    n = np.diff(offsets)
    total, some = np.zeros(len(n), np.uint64), n > 0
    if len(values):
        total[some] = np.add.reduceat(mixed(values, 20 + k), offsets[:-1][some])
    prints = mixed(total + n.astype(np.uint64), 22).view(np.int64)
    prints[~some] = 0
    return prints


class _New:
    """Tells sets that come for the first time since the last flush."""

    def __init__(self) -> None:
        self.seen: set[int] = set()

    def among(self, prints: np.ndarray, n: np.ndarray) -> np.ndarray:
        fresh = np.zeros(len(n), bool)
        for i, f in enumerate(prints.tolist()):
            if n[i] and f not in self.seen:
                self.seen.add(f)
                fresh[i] = True
        return fresh


def _describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Task: descriptions of the documents, and the shingles that occur in several sets among a few thousand."""

    def often(held: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        shingle, count = np.unique(np.concatenate(held), return_counts=True)
        use = count >= _OFTEN
        if use.any():
            rows = int(use.sum())
            yield _batch(_DESCRIBED_ARROW, rows, kind=np.full(rows, _OFTEN_HERE, np.int32), n=count[use], f1=shingle[use].view(np.int64))

    held, total, new = [], 0, _New()
    for batch in _slices(batches):
        values, offsets = shingle_sets(*arrow_bytes(batch.column("text")))
        n = np.diff(offsets)
        prints = [_print(values, offsets, k) for k in (0, 1)]
        f1, f2 = (pa.array(p, pa.int64(), mask=n == 0) for p in prints)
        kind = np.full(len(n), _META, np.int32)
        yield _batch(_DESCRIBED_ARROW, len(n), kind=kind, doc_id=batch.column("doc_id"), text_key=batch.column("text_key"), n=n, f1=f1, f2=f2)
        held.append(values[np.repeat(new.among(prints[0], n), n)])
        total += len(held[-1])
        if total > _COUNTED:
            yield from often(held)
            held, total, new = [], 0, _New()
    if total:
        yield from often(held)
    held = []
    pa.default_memory_pool().release_unused()


def _common(described: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """The most common shingles, sorted, with their classes; they decide on ranks only, never on what is linked."""
    counts = described.filter(F.col("kind") == _OFTEN_HERE).groupBy(F.col("f1").alias("shingle")).agg(F.sum("n").alias("n"))
    found = counts.filter(F.col("n") >= _COMMON_SETS).orderBy(F.desc("n"), "shingle").limit(_COMMON).toArrow().combine_chunks()
    shingle = found.column("shingle").to_numpy().view(np.uint64)
    order = np.argsort(shingle)
    return shingle[order], np.log2(found.column("n").to_numpy()[order]).astype(np.uint8)


def _signer(parts: int, percent: int, common: tuple[np.ndarray, np.ndarray] | None):
    """Task: the folded entries dealt to parts, and local edges."""

    def out(entries: list[np.ndarray], nodes: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        entry, node, hub, other = _fold(np.concatenate(entries), np.concatenate(nodes))
        entry = mixed(entry, 8)
        part = (entry % np.uint64(parts)).astype(np.int32)
        order = np.argsort(part, kind="stable")
        cuts = np.searchsorted(part[order], np.arange(parts + 1))
        full = np.flatnonzero(np.diff(cuts))
        slices = [order[cuts[p] : cuts[p + 1]] for p in full]
        entry >>= np.uint64(64 - 8 * _BYTES)
        if len(full):
            yield _batch(_SIGNED_ARROW, len(full), part=full.astype(np.int32), entries=[_packed(entry[s]) for s in slices], nodes=[_packed(node[s]) for s in slices])
        a, b = _forest(hub, other)
        if len(a):
            yield _batch(_SIGNED_ARROW, 1, part=[int(mixed(a[:1].astype(np.uint64))[0] % np.uint64(parts))], a=[a.tobytes()], b=[b.tobytes()])

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        entries, nodes, held, new = [], [], 0, _New()
        for batch in _slices(batches):
            values, offsets = shingle_sets(*arrow_bytes(batch.column("text")))
            prints = _print(values, offsets, 0)
            fresh = new.among(prints, np.diff(offsets))
            entry, owner = index_entries(values, offsets, percent, common)
            use = fresh[owner]
            entries.append(entry[use])
            nodes.append(prints[owner[use]] & _NODE)
            held += len(entries[-1])
            if held > _FLUSH:
                yield from out(entries, nodes)
                entries, nodes, held, new = [], [], 0, _New()
        if entries:
            yield from out(entries, nodes)
        entries, nodes = [], []
        pa.default_memory_pool().release_unused()

    return task


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The batches again in parts of about _SLICE bytes of text, a text at least: work arrays are many times its size."""
    for batch in batches:
        ends = np.cumsum(pc.fill_null(pc.binary_length(batch.column("text")), 0).to_numpy(zero_copy_only=False))
        first = 0
        while first < batch.num_rows:
            done = int(ends[first - 1]) if first else 0
            last = max(first + 1, int(np.searchsorted(ends, done + _SLICE, "right")))
            yield batch.slice(first, last - first)
            first = last


def _part_edges(table: pa.Table) -> pa.Table:
    held = {c: [x for x in table.column(c).to_pylist() if x is not None] for c in ("entries", "nodes", "a", "b")}
    entries, nodes = ([_unpacked(x) for x in held[c]] for c in ("entries", "nodes"))
    a, b = ([np.frombuffer(x, np.int64) for x in held[c]] for c in ("a", "b"))
    if entries:
        _, _, hub, other = _fold(np.concatenate(entries), np.concatenate(nodes).view(np.int64))
        a, b = [*a, hub], [*b, other]
    a, b = _forest(np.concatenate(a), np.concatenate(b))
    return pa.table({"a": a, "b": b})


def linked_roots(values: np.ndarray, offsets: np.ndarray, ids: np.ndarray, percent: int = PERCENT, side: np.ndarray | None = None):
    """The links among the sets as stars (id, least id). With side, only those between different sides count."""
    n = np.diff(offsets)
    vocabulary, token, count = np.unique(values, return_inverse=True, return_counts=True)
    rare = np.empty(len(vocabulary), np.int64)
    rare[np.argsort(count, kind="stable")] = np.arange(len(vocabulary))
    token = rare[token]
    frequency = np.empty(len(vocabulary), np.int64)
    frequency[rare] = count
    for i in range(len(n)):
        token[offsets[i] : offsets[i + 1]].sort()
    prefix = np.where(n > 0, n - (percent * n + 99) // 100 + 1, 0)
    owner = np.repeat(np.arange(len(n)), n)
    early = (np.arange(len(token)) - offsets[owner] < prefix[owner]) & (frequency[token] > 1)
    by_size = np.lexsort((ids, n))
    turn = np.empty(len(n), np.int64)
    turn[by_size] = np.arange(len(n))
    posted_token, posted_doc = token[early], owner[early]
    order = np.lexsort((turn[posted_doc], posted_token))
    posted_token, posted_doc = posted_token[order], posted_doc[order]
    begin = np.searchsorted(posted_token, np.arange(len(vocabulary) + 1))
    label = np.arange(len(n))
    members = {i: [i] for i in range(len(n))}
    mark = np.zeros(len(vocabulary), bool)

    def union(x: int, y: int) -> None:
        x, y = label[x], label[y]
        if x == y:
            return
        if len(members[x]) < len(members[y]):
            x, y = y, x
        label[members[y]] = x
        members[x] += members.pop(y)

    for x in by_size:
        own = token[offsets[x] : offsets[x + 1]]
        head = own[: prefix[x]]
        head = head[frequency[head] > 1]
        if not len(head):
            continue
        lengths = begin[head + 1] - begin[head]
        spot = np.repeat(begin[head] - np.concatenate([[0], np.cumsum(lengths)[:-1]]), lengths) + np.arange(lengths.sum())
        found = posted_doc[spot]
        keep = (turn[found] < turn[x]) & (label[found] != label[x]) & (100 * n[found] >= percent * n[x])
        if side is not None:
            keep &= side[found] != side[x]
        found = np.unique(found[keep])
        if not len(found):
            continue
        mark[own] = True
        step = max(1, 4_000_000 // int(n[x]))
        for k in range(0, len(found), step):
            some = found[k : k + step]
            sizes = n[some]
            first = np.concatenate([[0], np.cumsum(sizes)[:-1]])
            common = np.add.reduceat(mark[token[np.repeat(offsets[some] - first, sizes) + np.arange(sizes.sum())]].astype(np.int64), first)
            for y in some[(100 + percent) * common >= percent * (n[x] + sizes)]:
                union(x, y)
        mark[own] = False
    roots = np.array([ids[m].min() for m in members.values()], np.int64)
    flat = np.concatenate([m for m in members.values()]) if members else np.empty(0, np.int64)
    root = np.repeat(roots, [len(m) for m in members.values()])
    moved = ids[flat] != root
    return ids[flat][moved], root[moved]


def _group_links(percent: int):
    def links(table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        ids = table.column("doc_id").to_numpy()
        keys = np.stack([ids, table.column("text_key").to_numpy()], 1)
        _, first = np.unique(keys, axis=0, return_index=True)
        table, ids = table.take(pa.array(first)), ids[first]
        values, offsets = shingle_sets(*arrow_bytes(table.column("text")))
        low, high = table.column("low")[0].as_py(), table.column("high")[0].as_py()
        side = None if low == high else table.column("block").to_numpy()
        a, b = linked_roots(values, offsets, ids, percent, side)
        return pa.table({"a": a, "b": b})

    return links


def _grouped(members: DataFrame, block_shingles: int) -> DataFrame:
    """members with the task group (grp, low, high) and block; a large component's rows once per pair of blocks."""
    weight = members.groupBy("root").agg(F.sum("n").alias("weight"))
    small = weight.filter(F.col("weight") <= block_shingles).agg(F.sum("weight")).first()[0] or 0
    bins = int(small // (block_shingles // 2)) + 1
    blocks = F.ceil(F.col("weight") / F.lit(block_shingles)).cast("int")
    block = F.pmod(F.xxhash64("doc_id", "text_key"), F.col("blocks")).cast("int")
    out = members.join(weight, "root").withColumn("blocks", blocks).withColumn("block", block)
    out = out.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    group = F.when(F.col("blocks") == 1, F.pmod(F.xxhash64("root"), F.lit(bins))).otherwise(F.xxhash64("root", F.lit("blocks")))
    return out.select(
        "doc_id", "text_key", "block", group.alias("grp"), F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high")
    )


def near_duplicates(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", percent: int = PERCENT, block_shingles: int = BLOCK_SHINGLES
) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id (the smallest id reachable by links).

    Null and empty texts have 0 shingles and link with nothing. Ids are long; a row without an id takes
    the component of the rows with the same shingles, or null if no such row has an id. An id that
    occurs with several texts stands for all of them.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(f"`{doc_id}`").cast("long").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    rows = rows.withColumn("text_key", F.xxhash64("text"))
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 2 * docs.rdd.getNumPartitions())
    path = shared_path(spark, "jaccard")
    with arrow_batches(spark, TEXT_ROWS):
        rows.mapInArrow(_describe, _DESCRIBED).write.partitionBy("kind").parquet(path)
    described = spark.read.schema(_DESCRIBED).parquet(path)

    # entries take more room than the texts: they go straight to their parts and are not stored
    signed = rows.select("text").mapInArrow(_signer(parts, percent, _common(described)), _SIGNED)
    edges = signed.groupBy("part").applyInArrow(_part_edges, "a long, b long")
    with arrow_batches(spark, TEXT_ROWS):
        candidates = components(edges)

    meta = described.filter(F.col("kind") == _META).drop("kind")
    first = F.min(F.when(F.col("doc_id").isNotNull(), F.struct("doc_id", "text_key"))).alias("first")
    classes = meta.filter("n > 0").groupBy("f1", "f2").agg(first, F.max("n").alias("n"))
    classes = stored(classes.select("f1", "f2", "n", "first.*"), "classes")
    members = classes.filter("doc_id IS NOT NULL").join(candidates, F.col("f1").bitwiseAND(F.lit(_NODE)) == F.col("node"))
    members = stored(_grouped(members.select("root", "n", "doc_id", "text_key"), block_shingles), "members")
    keys = ["doc_id", "text_key"]
    texts = marked(rows, members, keys, "candidate").filter("candidate").drop("candidate")
    texts = texts.hint("merge").join(members, keys)  # the same plan at every size
    links = texts.groupBy("grp", "low", "high").applyInArrow(_group_links(percent), "a long, b long")
    with arrow_batches(spark, TEXT_ROWS):
        links = stored(links, "links")
    linked = components(links)

    named = classes.join(linked, F.col("doc_id") == F.col("node"), "left")
    named = named.select("f1", "f2", F.coalesce("root", "doc_id").alias("component_id"))
    found = meta.join(named, ["f1", "f2"], "left")
    component = F.when(F.col("n") == 0, F.col("doc_id")).otherwise(F.col("component_id"))
    return found.select("doc_id", F.col("n").alias("n_shingles"), component.alias("component_id"))


def one_of_each(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", percent: int = PERCENT) -> DataFrame:
    """One row of each component of near duplicates: the one with the smallest id, a row without an id last.

    Texts and not ids are linked, so a row without an id, or with the id of another text, counts by its own
    text; of rows with the same id and text one stays. Rows without shingles link with nothing: all stay.
    """
    own, key = F.col(f"`{doc_id}`").cast("long"), F.xxhash64(F.col(f"`{text}`"))
    found = near_duplicates(docs.select(key.alias("key"), F.col(f"`{text}`").alias("text")), "key", "text", percent)
    found = found.groupBy(F.col("doc_id").alias("key")).agg(F.max("n_shingles").alias("n"), F.min("component_id").alias("component"))
    known = docs.select(own.alias("id"), key.alias("key")).join(found, "key")
    known = stored(known.select("id", "key", "component", (F.col("n") == 0).alias("lone")), "known")
    lone = F.col("lone")
    least = F.min(F.struct(F.col("id").isNull().alias("none"), "id", "key")).alias("least")
    kept = known.groupBy(F.when(~lone, F.col("component")), F.when(lone, F.col("key")), F.when(lone, F.col("id")), "lone").agg(least)
    kept = kept.select("lone", F.col("least.key").alias("_key"), F.coalesce("least.id", F.lit(0)).alias("_id"), F.col("least.none").alias("_none"))
    # a row alone in its component, or without shingles, stays where it is: only the others are dealt out
    linked = known.filter(~lone)
    several = stored(linked.groupBy("component").agg(F.count(F.lit(1)).alias("rows")).filter("rows > 1").select("component"), "several")
    involved = marked(linked, several, ["component"], "_several").filter("_several")
    involved = stored(involved.select(F.col("key").alias("_key")).distinct(), "involved")
    rows = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"),
        key.alias("_key"), F.coalesce(own, F.lit(0)).alias("_id"), own.isNull().alias("_none"),
    )
    rows = marked(rows, involved, ["_key"], "_involved")
    turn = F.row_number().over(W.partitionBy("_key", "_id", "_none").orderBy(F.lit(0)))
    dealt = rows.filter("_involved").hint("merge").join(kept, ["_key", "_id", "_none"])
    dealt = dealt.withColumn("turn", turn).filter("lone OR turn = 1")
    return rows.filter("NOT _involved").select("_row.*").unionByName(dealt.select("_row.*"))
