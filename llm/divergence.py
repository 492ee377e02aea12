"""Audit of how far each source's term distribution strays from its language's and its siblings'.

Document frequencies are folded in every task and summed by Spark. The kept terms of each language (in at least MIN_DOCS of its
documents), sorted by their UTF-8 bytes, become a minimal acyclic transducer: equal suffix states are
shared, and the outputs along a path add up to the term's lexicographic ordinal. Texts are streamed
through it to recount occurrences per (lang, source), folded in every task; the ordinals stand for the
terms from then on and break ties, since their order is the order of the terms' bytes.

Shares are exact integers: p = 1 + floor(10^9 (count + 5) / (N + 5 V)) for every kept term, N the
group's count over kept terms, V the language's number of kept terms (decimal arithmetic, no overflow).
Part `pair` sums |p - q| over all kept terms against each other source of the language; part `term` lists
the terms a group uses (count > 0) more than its language does (p > q), the 50 largest.

Defined cases: null text, lang or source count as ''; an empty or term-less text adds to no count but its
group still appears, with zero counts; a language without kept terms gives every pair the value 0 and no
term rows; a language with one source has no pair rows. Very long texts and terms are read whole. Other
columns are ignored. Repeated rows count as often as they occur.

The vocabulary of one language meets in one task to build its transducer: its size is the number of
distinct kept terms, not of rows. The transducers are broadcast only when their total size is at most
BROADCAST_BYTES; beyond that the recount is a join of terms with the vocabulary.
"""

from __future__ import annotations

import io
from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from llm.shared import lower_ascii, stored

# Fixed values of the contract: the term pattern, the least document count, the smoothing and scale.
TERM = r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+"
MIN_DOCS = 30
SMOOTH = 5
SCALE = 1_000_000_000
TOP_TERMS = 50
BROADCAST_BYTES = 64 << 20
_FLUSH = 500_000
# per byte of a term's text: A-Z lower-cased, the bytes that TERM leaves out as spaces
_BYTES = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


class Transducer:
    """Minimal acyclic transducer of sorted byte strings to their ordinals, as flat arrays."""

    def __init__(self, final: np.ndarray, first: np.ndarray, labels: np.ndarray, targets: np.ndarray, outputs: np.ndarray):
        self.final, self.first, self.labels, self.targets, self.outputs = final, first, labels, targets, outputs

    @classmethod
    def build(cls, words: Iterable[bytes]) -> Transducer:
        """Daciuk's incremental construction for sorted input: the path of the previous word below the
        common prefix is minimised (replaced by an equal registered state) before the next word is added."""
        edges: list[dict[int, int]] = [{}]
        final = [False]
        register: dict[tuple, int] = {}
        unchecked: list[tuple[int, int, int]] = []
        previous = b""

        def minimise(down_to: int) -> None:
            while len(unchecked) > down_to:
                parent, label, child = unchecked.pop()
                signature = (final[child], tuple(sorted(edges[child].items())))
                known = register.get(signature)
                if known is None:
                    register[signature] = child
                else:
                    edges[parent][label] = known

        for word in words:
            if word <= previous and previous:
                if word == previous:
                    continue
                raise ValueError("words must be sorted by their bytes")
            common = 0
            for x, y in zip(word, previous):
                if x != y:
                    break
                common += 1
            minimise(common)
            node = unchecked[-1][2] if unchecked else 0
            for label in word[common:]:
                edges.append({})
                final.append(False)
                edges[node][label] = len(edges) - 1
                unchecked.append((node, label, len(edges) - 1))
                node = len(edges) - 1
            final[node] = True
            previous = word
        minimise(0)
        return cls._flattened(edges, final)

    @classmethod
    def _flattened(cls, edges: list[dict[int, int]], final: list[bool]) -> Transducer:
        """Reachable states renumbered in depth-first order; outputs are the words below smaller labels."""
        order, seen, stack = [], {0: 0}, [0]
        while stack:
            state = stack.pop()
            order.append(state)
            for target in edges[state].values():
                if target not in seen:
                    seen[target] = len(seen)
                    stack.append(target)
        counts: dict[int, int] = {}
        pending = [(0, False)]
        while pending:  # post-order without recursion: terms may be very long
            state, done = pending.pop()
            if state in counts:
                continue
            if done:
                counts[state] = int(final[state]) + sum(counts[t] for t in edges[state].values())
                continue
            pending.append((state, True))
            pending.extend((t, False) for t in edges[state].values() if t not in counts)
        number = {s: i for i, s in enumerate(sorted(seen, key=seen.get))}
        states = sorted(seen, key=seen.get)
        first = np.zeros(len(states) + 1, np.int64)
        labels, targets, outputs = [], [], []
        for i, state in enumerate(states):
            below = int(final[state])
            for label, target in sorted(edges[state].items()):
                labels.append(label)
                targets.append(number[target])
                outputs.append(below)
                below += counts[target]
            first[i + 1] = len(labels)
        return cls(
            np.array([final[s] for s in states], np.bool_), first, np.array(labels, np.uint8),
            np.array(targets, np.int64), np.array(outputs, np.int64),
        )

    def ordinal(self, word: bytes) -> int:
        """The word's place among the built words, -1 if it is none of them."""
        moves = self._moves()
        state, total = 0, 0
        for byte in word:
            move = moves[state].get(byte)
            if move is None:
                return -1
            total += move[1]
            state = move[0]
        return total if self._final[state] else -1

    def _moves(self) -> list[dict[int, tuple[int, int]]]:
        """Each state's transitions as label -> (target, output), made once from the flat arrays."""
        if getattr(self, "_table", None) is None:
            labels, targets, outputs, first = self.labels.tolist(), self.targets.tolist(), self.outputs.tolist(), self.first.tolist()
            self._table = [
                {labels[k]: (targets[k], outputs[k]) for k in range(first[s], first[s + 1])} for s in range(len(first) - 1)
            ]
            self._final = self.final.tolist()
        return self._table

    def to_bytes(self) -> bytes:
        out = io.BytesIO()
        np.savez(out, final=self.final, first=self.first, labels=self.labels, targets=self.targets, outputs=self.outputs)
        return out.getvalue()

    @classmethod
    def from_bytes(cls, data: bytes) -> Transducer:
        arrays = np.load(io.BytesIO(data))
        return cls(*(arrays[k] for k in ("final", "first", "labels", "targets", "outputs")))


def _terms(text: Column) -> Column:
    """The text's terms: the pieces between runs of other characters (the same as the matches of TERM)."""
    return F.array_remove(F.split(lower_ascii(text), r"[\x00-\x40\x5B-\x60\x7B-\x7F]+", -1), "")


def prepared(docs: DataFrame) -> DataFrame:
    return docs.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source", "text")])


def _words(text: bytes) -> list[bytes]:
    """The text's terms in UTF-8: separators are ASCII, so that no byte of another character is one."""
    return text.translate(_BYTES).split()


def _document_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """lang, term, docs: in how many of the task's documents each term occurs, folded in the task."""
    counts: dict[str, Counter] = {}
    distinct = 0

    def flush() -> Iterator[pa.RecordBatch]:
        for lang, terms in counts.items():
            term = pa.array(list(terms), pa.binary()).cast(pa.string())
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(terms), pa.string()), term, pa.array(list(terms.values()), pa.int64())], ["lang", "term", "docs"]
            )
        counts.clear()

    for batch in batches:
        for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text").to_pylist()):
            terms = counts.setdefault(lang, Counter())
            before = len(terms)
            terms.update(set(_words(text)))
            distinct += len(terms) - before
            if distinct > _FLUSH:
                yield from flush()
                distinct = 0
    yield from flush()


def kept_terms(docs: DataFrame, min_docs: int = MIN_DOCS) -> DataFrame:
    """lang, term of the terms in at least min_docs documents of their language."""
    per_task = docs.select("lang", F.col("text").cast("binary").alias("text")).mapInArrow(_document_counts, "lang string, term string, docs long")
    return per_task.groupBy("lang", "term").agg(F.sum("docs").alias("docs")).filter(F.col("docs") >= min_docs).select("lang", "term")


def _built(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """One row with the transducer of the language, then its terms with their ordinals. The language's terms
    come in several batches; its transducer holds them all."""
    lang, found = "", set()
    for frame in batches:
        lang = frame.lang.iloc[0]
        found.update(t.encode("utf-8") for t in frame.term)
    words = sorted(found)
    fst = Transducer.build(words)
    yield pd.DataFrame({"lang": [lang], "fst": [fst.to_bytes()], "n_terms": [len(words)], "ordinal": [None], "term": [None]})
    for start in range(0, len(words), _FLUSH):
        part = words[start : start + _FLUSH]
        yield pd.DataFrame(
            {"lang": lang, "fst": None, "n_terms": None, "ordinal": np.arange(start, start + len(part)), "term": [w.decode("utf-8") for w in part]}
        )


def transducers(vocabulary: DataFrame) -> DataFrame:
    """lang, fst (bytes of its transducer), n_terms, ordinal, term: a row with the transducer of every
    language with kept terms (ordinal, term null), and its terms with their ordinals (fst, n_terms null)."""
    schema = "lang string, fst binary, n_terms long, ordinal long, term string"
    return vocabulary.groupBy("lang").applyInPandas(_built, schema)


def _streamed(batches: Iterator[pa.RecordBatch], fsts: dict) -> Iterator[pa.RecordBatch]:
    """Occurrences of kept terms per (lang, source, ordinal), folded in the task: terms are counted as they
    come, and each distinct one of a language passes the transducer once per fold."""
    loaded: dict[str, Transducer] = {}
    memo: dict[str, dict[bytes, int]] = {}
    counts: dict[tuple[str, str], Counter] = {}
    distinct = 0

    def flush() -> Iterator[pa.RecordBatch]:
        for (lang, source), terms in counts.items():
            known = memo.setdefault(lang, {})
            for term in terms.keys() - known.keys():
                known[term] = loaded[lang].ordinal(term)
            ordinals = np.fromiter(map(known.__getitem__, terms), np.int64, len(terms))
            n = np.fromiter(terms.values(), np.int64, len(terms))
            kept = np.flatnonzero(ordinals >= 0)
            names = [pa.array([x] * len(kept), pa.string()) for x in (lang, source)]
            yield pa.RecordBatch.from_arrays([*names, pa.array(ordinals[kept]), pa.array(n[kept])], ["lang", "source", "ordinal", "n"])
        counts.clear()
        if sum(map(len, memo.values())) > 2 * _FLUSH:
            memo.clear()

    for batch in batches:
        for lang, source, text in zip(*(batch.column(c).to_pylist() for c in ("lang", "source", "text"))):
            if lang not in fsts or not text:
                continue
            if lang not in loaded:
                loaded[lang] = Transducer.from_bytes(fsts[lang].value)
            terms = counts.setdefault((lang, source), Counter())
            before = len(terms)
            terms.update(_words(text))
            distinct += len(terms) - before
            if distinct > _FLUSH:
                yield from flush()
                distinct = 0
    yield from flush()


def recounted(docs: DataFrame, ordinals: DataFrame, fsts: DataFrame, broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """lang, source, ordinal, n: occurrences of each kept term in each group, streamed through the transducers
    when they may be broadcast, else by a join of all term occurrences with the vocabulary."""
    spark = docs.sparkSession
    size = fsts.agg(F.coalesce(F.sum(F.length("fst")), F.lit(0))).first()[0]
    if size <= broadcast_bytes:
        shipped = {r.lang: spark.sparkContext.broadcast(bytes(r.fst)) for r in fsts.select("lang", "fst").collect()}
        texts = docs.select("lang", "source", F.col("text").cast("binary").alias("text"))
        counts = texts.mapInArrow(lambda it: _streamed(it, shipped), "lang string, source string, ordinal long, n long")
    else:
        terms = docs.select("lang", "source", F.explode(_terms(F.col("text"))).alias("term"))
        counts = terms.join(ordinals, ["lang", "term"]).select("lang", "source", "ordinal", F.lit(1).cast("long").alias("n"))
    return counts.groupBy("lang", "source", "ordinal").agg(F.sum("n").cast("long").alias("n"))


def _share(n: Column, total: Column, v: Column) -> Column:
    """1 + floor(10^9 (n + 5) / (N + 5 V)) in exact decimal arithmetic."""
    big = "decimal(38,0)"
    top = F.lit(SCALE).cast(big) * (n.cast(big) + F.lit(SMOOTH).cast(big))
    return (F.lit(1) + F.floor(top / (total.cast(big) + F.lit(SMOOTH).cast(big) * v.cast(big)))).cast("long")


def audited(docs: DataFrame, min_docs: int = MIN_DOCS, broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """lang, source, part ('pair' or 'term'), item, value long, rank int for every (lang, source) group of docs."""
    docs = prepared(docs)  # read twice from the input rather than stored: a copy of all text costs more
    built = stored(transducers(kept_terms(docs, min_docs)), "divergence-fst")
    fsts = built.filter(F.col("fst").isNotNull()).select("lang", "fst", F.col("n_terms").alias("v"))
    ordinals = built.filter(F.col("fst").isNull()).select("lang", "term", "ordinal")
    counts = stored(recounted(docs, ordinals, fsts, broadcast_bytes), "divergence-counts")
    groups = docs.select("lang", "source").distinct()
    sizes = fsts.select("lang", "v")
    group_totals = counts.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    totals = groups.join(sizes, "lang").join(group_totals, ["lang", "source"], "left").withColumn("total", F.coalesce("total", F.lit(0)))
    totals = totals.withColumn("lang_total", F.sum("total").over(W.partitionBy("lang")))
    grid = totals.select("*", F.explode(F.sequence(F.lit(0).cast("long"), F.col("v") - 1)).alias("ordinal"))
    grid = grid.join(counts, ["lang", "source", "ordinal"], "left").withColumn("n", F.coalesce("n", F.lit(0).cast("long")))
    # the language's count of a term is a sum over its groups' rows of the grid: no join of the two is needed
    grid = grid.withColumn("lang_n", F.sum("n").over(W.partitionBy("lang", "ordinal")))
    grid = stored(grid.withColumn("p", _share(F.col("n"), F.col("total"), F.col("v"))).drop("total"), "divergence-grid")

    other = grid.select("lang", "ordinal", F.col("source").alias("item"), F.col("p").alias("q"))
    summed = grid.select("lang", "ordinal", "source", "p").join(other, ["lang", "ordinal"]).filter(F.col("source") < F.col("item"))
    summed = summed.groupBy("lang", "source", "item").agg(F.sum(F.abs(F.col("p") - F.col("q"))).cast("long").alias("value"))
    both = F.array(F.struct(F.col("source"), F.col("item")), F.struct(F.col("item").alias("source"), F.col("source").alias("item")))
    summed = summed.select("lang", F.explode(both).alias("b"), "value").select("lang", "b.source", "b.item", "value")
    siblings = groups.join(groups.withColumnRenamed("source", "item"), "lang").filter(F.col("source") != F.col("item"))
    pairs = siblings.join(summed, ["lang", "source", "item"], "left").select("lang", "source", "item", F.coalesce("value", F.lit(0).cast("long")).alias("value"))
    by_item = W.partitionBy("lang", "source").orderBy(F.desc("value"), F.col("item").cast("binary"))
    pairs = pairs.select("lang", "source", F.lit("pair").alias("part"), "item", "value", F.row_number().over(by_item).cast("int").alias("rank"))

    over = grid.filter(F.col("n") > 0).withColumn("q", _share(F.col("lang_n"), F.col("lang_total"), F.col("v"))).filter(F.col("p") > F.col("q"))
    over = over.select("lang", "source", "ordinal", (F.col("p") - F.col("q")).alias("value"))
    by_term = W.partitionBy("lang", "source").orderBy(F.desc("value"), "ordinal")
    top = over.withColumn("rank", F.row_number().over(by_term)).filter(F.col("rank") <= TOP_TERMS)
    terms = top.join(ordinals, ["lang", "ordinal"]).select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), "value", F.col("rank").cast("int"))
    return pairs.unionByName(terms)
