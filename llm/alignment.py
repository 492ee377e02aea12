"""Alignment of two tokenizations of the same text, and corpus-wide counts of the token pairs it links.

A text is encoded by a byte-level BPE (A, on space + text) and a sentencepiece BPE (B, which adds the
space itself). Byte offsets where an A token and a B token both end cut the two sequences into groups;
every A token of a group is linked with every B token of it.

The alignment walks the token ends with a current index shift (j - i). From a group boundary it probes
exponentially longer stretches, comparing the A ends with the B ends at that shift, and jumps the whole
stretch of one-to-one groups; at the first mismatch it resolves the irregular group locally (advancing
whichever side ends first until the ends meet) and carries on with the new shift. Texts are cut where no
token of either side crosses (a single space between visible characters; checked on the tokenizers), so that
both sides have a common end there: new parts are encoded and aligned together as one long sequence, and
parts met before are looked up. Tokenizing and aligning run in tasks over Arrow batches; the counts of pairs
over documents, each pair's best count per A id and the per-document sums are Spark aggregates and joins.

Defined cases: a null or empty text, or one whose joined A or B token bytes differ from space + text
(sentencepiece may normalise, or emit <unk>), has no tokens: all figures 0 and groups_sha256 ''. Special
tokens' strings inside texts are plain text. Very long texts are tokenized whole. Rows that repeat a
doc_id, or have none, are separate documents (the count of a pair is over rows). Other columns are ignored.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from llm.shared import arrow_batches, stored

BYTE_BPE = "/opt/tokenizers/byte_bpe_50k.json"
PIECE_BPE = "/opt/tokenizers/piece_bpe_32k.model"
TEXT_ROWS = 200
CHUNK_CHARS = 1 << 20
MEMO_CHARS, MEMO_PARTS = 4 << 20, 250_000
JOINT_PARTS = 2000
VISIBLE = "[!-~À-ɏ]"
WIDE_LINKS = 4096
BROADCAST_PAIRS = 2_000_000
_TOKENIZED = (
    "_row long, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, "
    "pairs array<struct<a:int,b:int,m:long>>"
)


def _byte_alphabet() -> dict[str, int]:
    """Byte-level BPE's printable stand-in of each byte: printable Latin-1 bytes stand for themselves,
    the others take code points from 256 up, in byte order."""
    own = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    table, extra = {}, 0
    for byte in range(256):
        if byte in own:
            table[chr(byte)] = byte
        else:
            table[chr(256 + extra)] = byte
            extra += 1
    return table


@lru_cache(maxsize=2)
def _tokenizers(byte_bpe: str, piece_bpe: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # one thread per task: Spark deals the texts to the cores
    import sentencepiece
    from tokenizers import Tokenizer

    a = Tokenizer.from_file(byte_bpe)
    a.encode_special_tokens = True
    alphabet = _byte_alphabet()
    a_bytes = [b""] * a.get_vocab_size()
    for token, i in a.get_vocab().items():
        a_bytes[i] = bytes(alphabet[c] for c in token) if all(c in alphabet for c in token) else token.encode("utf-8")
    b = sentencepiece.SentencePieceProcessor(model_file=piece_bpe)
    b_bytes = []
    for i in range(b.get_piece_size()):
        piece = b.id_to_piece(i)
        if b.is_byte(i):
            b_bytes.append(bytes([int(piece[3:5], 16)]))
        else:
            b_bytes.append(piece.replace("▁", " ").encode("utf-8"))
    a_len = np.array([len(x) for x in a_bytes], np.int64)
    b_len = np.array([len(x) for x in b_bytes], np.int64)
    return a, b, a_bytes, b_bytes, a_len, b_len


@lru_cache(maxsize=2)
def _cut(byte_bpe: str, piece_bpe: str) -> re.Pattern | None:
    """Where a text may be cut into parts encoded apart, without changing a token of either side: at a single
    space between two visible ASCII or Latin characters. A's splitting expression starts a new piece at such a space,
    and no piece of B holds the space mark after another character, so that no merge of either side crosses
    it. None (texts are encoded whole) for tokenizers that are not built so."""
    a, b, *_ = _tokenizers(byte_bpe, piece_bpe)
    config = json.loads(a.to_str())
    before = config["pre_tokenizer"] or {}
    pieces = [before, *before.get("pretokenizers", [])]
    level = [x for x in pieces if x.get("type") == "ByteLevel"]
    plain = (
        config["normalizer"] is None and len(pieces) == 1 and len(level) == 1
        and not level[0]["add_prefix_space"] and level[0].get("use_regex", True)
        and all(t["special"] for t in config["added_tokens"])
    )
    inner = re.compile("[^▁]▁")
    plain = plain and not any(inner.search(b.id_to_piece(i)) for i in range(b.get_piece_size()))
    return re.compile(f"(?<={VISIBLE}) (?={VISIBLE})") if plain else None


class _Parts:
    """Aligned parts of texts, each worked on once and then looked up by its number: what it adds to the digest,
    its n_a, n_b, n_groups, n_links, and its distinct id pairs with their multiplicity. Forgotten together before
    a chunk that finds more than MEMO_CHARS characters or MEMO_PARTS parts."""

    def __init__(self, byte_bpe: str, piece_bpe: str):
        self.a, self.b, self.a_bytes, self.b_bytes, self.a_len, self.b_len = _tokenizers(byte_bpe, piece_bpe)
        self.cut = _cut(byte_bpe, piece_bpe)
        self.forget()

    def forget(self) -> None:
        self.number: dict[str, int] = {}
        self.said: list[bytes] = []
        self.odd: dict[str, tuple[bytes, bytes]] = {}  # joined bytes of parts that differ from space + part
        self.figures = np.zeros((4, 0), np.int64)
        self.n_pairs = np.zeros(0, np.int64)
        self.pairs = np.zeros((2, 0), np.int64)
        self.chars = 0

    def learn(self, parts: list[str]) -> None:
        """Parts of visible ASCII and Latin characters are encoded as one text with single spaces, cut afterwards."""
        joint = list(filter(re.compile(f"{VISIBLE}+").fullmatch, parts)) if self.cut else []
        for start in range(0, len(joint), JOINT_PARTS):
            part = joint[start : start + JOINT_PARTS]
            self._keep(part, *(self._joint(part) or self._single(part)))
        rest = list(set(parts).difference(joint))
        for start in range(0, len(rest), JOINT_PARTS):
            part = rest[start : start + JOINT_PARTS]
            self._keep(part, *self._single(part))

    def _joint(self, parts: list[str]) -> list[np.ndarray] | None:
        """Ids of A, their number per part, and the same of B; None if the joined bytes are not the text's."""
        text = " " + " ".join(parts)
        want = text.encode("utf-8")
        ends = np.cumsum([len(p.encode("utf-8")) + 1 for p in parts])
        found = []
        found_a = self.a.encode_batch_fast([text], add_special_tokens=False)[0].ids
        for ids, names, sizes in ((found_a, self.a_bytes, self.a_len), (self.b.encode(text[1:]), self.b_bytes, self.b_len)):
            if b"".join(map(names.__getitem__, ids)) != want:
                return None
            ids = np.array(ids, np.int64)
            through = np.cumsum(sizes[ids])
            cuts = np.searchsorted(through, ends) + 1
            if (through[cuts - 1] != ends).any():
                return None
            found += [ids, np.diff(cuts, prepend=0)]
        return found

    def _single(self, parts: list[str]) -> list[np.ndarray]:
        """The same for parts encoded one by one; odd ones are noted and have no ids."""
        found_a = [e.ids for e in self.a.encode_batch_fast([" " + p for p in parts], add_special_tokens=False)]
        found_b = self.b.encode(parts, num_threads=1)
        for k, part in enumerate(parts):
            want = (" " + part).encode("utf-8")
            joined = b"".join(map(self.a_bytes.__getitem__, found_a[k])), b"".join(map(self.b_bytes.__getitem__, found_b[k]))
            if joined != (want, want):
                self.odd[part] = joined
                found_a[k] = found_b[k] = []
        return [x for f in (found_a, found_b) for x in (np.array(list(chain.from_iterable(f)), np.int64), np.array([len(i) for i in f], np.int64))]

    def _keep(self, parts: list[str], ids_a: np.ndarray, count_a: np.ndarray, ids_b: np.ndarray, count_b: np.ndarray) -> None:
        figures, said, n_pairs, pairs = _aligned(ids_a, count_a, ids_b, count_b, self.a_len, self.b_len)
        self.number.update(zip(parts, range(len(self.said), len(self.said) + len(parts))))
        self.said += said
        self.figures = np.concatenate([self.figures, figures], axis=1)
        self.n_pairs = np.concatenate([self.n_pairs, n_pairs])
        self.pairs = np.concatenate([self.pairs, pairs], axis=1)
        self.chars += sum(map(len, parts))

    def of(self, texts: list[str]) -> list[list[str]]:
        """The parts of each text, all of them learned; none where the joined bytes of either side differ from
        space + text."""
        if self.chars > MEMO_CHARS or len(self.number) > MEMO_PARTS:
            self.forget()
        parted = [(self.cut.split(t) if self.cut else [t]) if t else [] for t in texts]
        self.learn(list(set(chain.from_iterable(parted)) - self.number.keys()))
        if self.odd:
            for k, (text, parts) in enumerate(zip(texts, parted)):
                if not self.odd.keys().isdisjoint(parts):
                    want = (" " + text).encode("utf-8")
                    joined = [b"".join(self.odd[p][s] if p in self.odd else (" " + p).encode("utf-8") for p in parts) for s in (0, 1)]
                    parted[k] = [text] if joined == [want, want] else []
                    self.learn([t for t in parted[k] if t not in self.number])
        return parted


def aligned_sizes(a_ends: np.ndarray, b_ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Per group between common ends, in order, its number of A tokens and of B tokens.
    Both arrays are increasing and end at the same offset."""
    a, b = a_ends.tolist(), b_ends.tolist()
    na, nb = len(a), len(b)
    runs: list[int] = []  # one-to-one groups before each irregular one, then its sizes
    wide_a: list[int] = []
    wide_b: list[int] = []
    i = j = 0
    while i < na and j < nb:
        i0, j0, step = i, j, 4
        while i < na and a[i : i + step] == b[j : j + step]:  # exponential probe along the diagonal of the current shift
            i, j, step = i + step, j + step, step * 2
        if i >= na:
            i, j = na, nb
        while i < na and step > 1:  # the mismatch lies within the last probe: halve it
            step //= 2
            if a[i : i + step] == b[j : j + step]:
                i, j = i + step, j + step
        runs.append(i - i0)
        i0, j0 = i, j  # an irregular group: advance the side that ends first until the ends meet
        if i < na:
            x, y = a[i], b[j]
            while x != y:
                if x < y:
                    i += 1
                    x = a[i]
                else:
                    j += 1
                    y = b[j]
            i, j = i + 1, j + 1
        wide_a.append(i - i0)
        wide_b.append(j - j0)
    run, last_a, last_b = (np.array(x, np.int64) for x in (runs, wide_a, wide_b))
    groups = run + (last_a > 0)
    size_a = np.ones(int(groups.sum()), np.int64)
    size_b = size_a.copy()
    at = (np.cumsum(groups) - 1)[last_a > 0]
    size_a[at], size_b[at] = last_a[last_a > 0], last_b[last_a > 0]
    return size_a, size_b


def aligned_groups(a_ends: np.ndarray, b_ends: np.ndarray) -> list[tuple[int, int, int, int]]:
    """Groups (i0, i1, j0, j1): A tokens i0..i1-1 and B tokens j0..j1-1 between common ends.
    Both arrays are increasing and end at the same offset."""
    size_a, size_b = aligned_sizes(a_ends, b_ends)
    i1, j1 = np.cumsum(size_a), np.cumsum(size_b)
    return list(zip((i1 - size_a).tolist(), i1.tolist(), (j1 - size_b).tolist(), j1.tolist()))


@lru_cache(maxsize=2)
def _said(n_a: int, n_b: int) -> np.ndarray:
    """What the digest holds for a token: A's ids within a group and at its end, then B's."""
    said = [b"%d%s" % (i, after) for n, end in ((n_a, b"|"), (n_b, b";")) for after in (b",", end) for i in range(n)]
    out = np.empty(len(said), object)
    out[:] = said
    return out


def _links(ids_a, ids_b, size_a, size_b, i0, j0, part, n_a: int, n_b: int) -> tuple[np.ndarray, np.ndarray]:
    """The distinct (part, A id, B id) as one number each, ascending, with how often they are linked."""
    key = part * n_a
    links = size_a * size_b
    one, wide = links == 1, np.flatnonzero((links > 1) & (links <= WIDE_LINKS))
    n = links[wide]
    group = np.repeat(wide, n)
    place = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
    found = [
        (key[one] + ids_a[i0[one]]) * n_b + ids_b[j0[one]],
        (key[group] + ids_a[i0[group] + place // size_b[group]]) * n_b + ids_b[j0[group] + place % size_b[group]],
    ]
    times = [np.ones(len(f), np.int64) for f in found]
    for g in np.flatnonzero(links > WIDE_LINKS):  # distinct ids first: the product of the sizes may be large
        x, nx = np.unique(ids_a[i0[g] : i0[g] + size_a[g]], return_counts=True)
        y, ny = np.unique(ids_b[j0[g] : j0[g] + size_b[g]], return_counts=True)
        found.append(((key[g] + x)[:, None] * n_b + y).ravel())
        times.append((nx[:, None] * ny).ravel())
    return _summed(np.concatenate(found), np.concatenate(times))


def _summed(keys: np.ndarray, times: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys, ascending, and the sum of their times."""
    order = np.argsort(keys)
    keys = keys[order]
    first = np.flatnonzero(np.diff(keys, prepend=-1))
    return keys[first], np.add.reduceat(times[order], first) if len(first) else times[:0]


def _aligned(ids_a, count_a, ids_b, count_b, a_len, b_len) -> tuple[np.ndarray, list[bytes], np.ndarray, np.ndarray]:
    """Per part its n_a, n_b, n_groups, n_links; its digest text; its number of distinct pairs; and the pairs of
    all, as A id * B's size + B id, with their multiplicity. The parts are aligned as one sequence: each ends at
    an offset common to both sides."""
    n, va, vb = len(count_a), len(a_len), len(b_len)
    size_a, size_b = aligned_sizes(np.cumsum(a_len[ids_a]), np.cumsum(b_len[ids_b]))
    i1, j1 = np.cumsum(size_a), np.cumsum(size_b)
    i0, j0 = i1 - size_a, j1 - size_b
    part = np.repeat(np.arange(n), count_a)[i0]
    groups = np.bincount(part, minlength=n)
    last = np.cumsum(groups)
    through = np.concatenate([[0], np.cumsum(size_a * size_b)])
    figures = np.stack([count_a, count_b, groups, through[last] - through[last - groups]])

    codes = np.empty(len(ids_a) + len(ids_b), np.int64)
    ends = np.zeros(len(ids_a), np.int64)
    ends[i1 - 1] = va
    codes[np.arange(len(ids_a)) + np.repeat(j0, size_a)] = ids_a + ends
    ends = np.zeros(len(ids_b), np.int64)
    ends[j1 - 1] = vb
    codes[np.arange(len(ids_b)) + np.repeat(i1, size_b)] = 2 * va + ids_b + ends
    names, at = _said(va, vb)[codes].tolist(), np.cumsum(count_a + count_b)
    said = [b"".join(names[x:y]) for x, y in zip((at - count_a - count_b).tolist(), at.tolist())]

    keys, times = _links(ids_a, ids_b, size_a, size_b, i0, j0, part, va, vb)
    n_pairs = np.diff(np.searchsorted(keys, np.arange(n + 1) * (va * vb)))
    return figures, said, n_pairs, np.stack([keys % (va * vb), times])


def _figures(texts: list[str], memo: _Parts) -> list[pa.Array]:
    """n_a, n_b, n_groups, n_links, groups_sha256 and the linked id pairs with their multiplicity, per text:
    the sums over its parts."""
    parted, n, vb = memo.of(texts), len(texts), len(memo.b_len)
    both = len(memo.a_len) * vb
    count = np.array([len(p) for p in parted], np.int64)
    numbers = np.array(list(map(memo.number.__getitem__, chain.from_iterable(parted))), np.int64)
    last = np.cumsum(count)
    through = np.zeros((4, len(numbers) + 1), np.int64)
    np.cumsum(memo.figures[:, numbers], axis=1, out=through[:, 1:])
    sums = through[:, last] - through[:, last - count]
    each, digests = list(map(memo.said.__getitem__, numbers.tolist())), []
    for x, y in zip((last - count).tolist(), last.tolist()):
        digests.append(hashlib.sha256(memoryview(b"".join(each[x:y]))[:-1]).hexdigest() if y > x else "")

    n_pairs = memo.n_pairs[numbers]
    at = np.repeat((np.cumsum(memo.n_pairs) - memo.n_pairs)[numbers] - (np.cumsum(n_pairs) - n_pairs), n_pairs) + np.arange(int(n_pairs.sum()))
    text = np.repeat(np.repeat(np.arange(n), count), n_pairs)
    keys, times = _summed(memo.pairs[0, at] + text * both, memo.pairs[1, at])
    offsets = np.searchsorted(keys, np.arange(n + 1) * both)
    pair = pa.StructArray.from_arrays(
        [pa.array((keys % both // vb).astype(np.int32)), pa.array((keys % vb).astype(np.int32)), pa.array(times)], ["a", "b", "m"]
    )
    pairs = pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pair)
    return [*[pa.array(x) for x in sums], pa.array(digests, pa.string()), pairs]


def _tokenized(batches: Iterator[pa.RecordBatch], byte_bpe: str, piece_bpe: str) -> Iterator[pa.RecordBatch]:
    memo = _Parts(byte_bpe, piece_bpe)
    names = ["_row", "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "pairs"]
    for batch in batches:
        texts = [t or "" for t in batch.column("text").to_pylist()]
        start = 0
        while start < len(texts):
            end, chars = start + 1, len(texts[start])
            while end < len(texts) and chars + len(texts[end]) <= CHUNK_CHARS:
                chars += len(texts[end])
                end += 1
            ids = [batch.column(c).slice(start, end - start) for c in ("_row", "doc_id")]
            yield pa.RecordBatch.from_arrays([*ids, *_figures(texts[start:end], memo)], names)
            start = end


def tokenized(docs: DataFrame, byte_bpe: str = BYTE_BPE, piece_bpe: str = PIECE_BPE) -> DataFrame:
    """Per row of docs: _row, doc_id, n_a, n_b, n_groups, n_links, groups_sha256, pairs (a, b, m), stored."""
    rows = docs.select(F.monotonically_increasing_id().alias("_row"), F.col("doc_id").cast("long"), F.col("text").cast("string"))
    with arrow_batches(docs.sparkSession, TEXT_ROWS):
        return stored(rows.mapInArrow(lambda it: _tokenized(it, byte_bpe, piece_bpe), _TOKENIZED), "alignment")


def aligned(docs: DataFrame, byte_bpe: str = BYTE_BPE, piece_bpe: str = PIECE_BPE, broadcast_pairs: int = BROADCAST_PAIRS) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256 for every row of docs."""
    found = tokenized(docs, byte_bpe, piece_bpe)
    links = found.select("_row", F.explode("pairs").alias("p")).select("_row", "p.a", "p.b", "p.m")
    counts = links.groupBy("a", "b").agg(F.count(F.lit(1)).alias("docs"))
    best = F.max("docs").over(W.partitionBy("a"))
    counts = stored(counts.select("a", "b", "docs", (F.col("docs") == best).alias("is_best")), "alignment-counts")
    few = counts.count() <= broadcast_pairs
    scored = links.join(F.broadcast(counts) if few else counts, ["a", "b"])
    sums = scored.groupBy("_row").agg(
        F.sum(F.when(F.col("is_best"), F.col("m")).otherwise(0)).cast("long").alias("n_best"),
        F.sum(F.col("m") * F.col("docs")).cast("long").alias("count_sum"),
    )
    out = found.drop("pairs").join(sums, "_row", "left")
    return out.select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links",
        F.coalesce("n_best", F.lit(0).cast("long")).alias("n_best"), F.coalesce("count_sum", F.lit(0).cast("long")).alias("count_sum"),
        "groups_sha256",
    )
