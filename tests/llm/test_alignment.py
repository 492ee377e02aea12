import hashlib
from collections import Counter

import numpy as np
import pyarrow.parquet as pq
import pytest

from llm import alignment

SCHEMA = "doc_id long, text string, other long"


def brute_groups(ends_a, ends_b):
    """Groups by the set of common ends, token by token."""
    common = sorted(set(ends_a) & set(ends_b))
    groups, i, j = [], 0, 0
    for end in common:
        i1 = ends_a.index(end) + 1
        j1 = ends_b.index(end) + 1
        groups.append((i, i1, j, j1))
        i, j = i1, j1
    return groups


def brute(rows):
    a, b, a_bytes, b_bytes, *_ = alignment._tokenizers(alignment.BYTE_BPE, alignment.PIECE_BPE)
    per = []
    for doc_id, text, _ in rows:
        zero = (doc_id, 0, 0, 0, 0, Counter(), "")
        if not text:
            per.append(zero)
            continue
        ia = a.encode(" " + text, add_special_tokens=False).ids
        ib = b.encode(text)
        want = (" " + text).encode()
        if b"".join(a_bytes[x] for x in ia) != want or b"".join(b_bytes[x] for x in ib) != want:
            per.append(zero)
            continue
        ea = list(np.cumsum([len(a_bytes[x]) for x in ia]))
        eb = list(np.cumsum([len(b_bytes[x]) for x in ib]))
        groups = brute_groups(ea, eb)
        links = Counter((x, y) for i0, i1, j0, j1 in groups for x in ia[i0:i1] for y in ib[j0:j1])
        text_ = ";".join(",".join(map(str, ia[i0:i1])) + "|" + ",".join(map(str, ib[j0:j1])) for i0, i1, j0, j1 in groups)
        per.append((doc_id, len(ia), len(ib), len(groups), sum(links.values()), links, hashlib.sha256(text_.encode()).hexdigest()))
    docs = Counter(p for row in per for p in row[5])
    best = {}
    for (x, _), n in docs.items():
        best[x] = max(best.get(x, 0), n)
    out = []
    for doc_id, na, nb, ng, nl, links, digest in per:
        n_best = sum(m for (x, y), m in links.items() if docs[(x, y)] == best[x])
        total = sum(m * docs[(x, y)] for (x, y), m in links.items())
        out.append((doc_id, na, nb, ng, nl, n_best, total, digest))
    return sorted(out, key=str)


def test_diagonal_skipping_equals_common_ends():
    rng = np.random.default_rng(1)
    for _ in range(200):
        total = int(rng.integers(1, 60))
        cuts_a = sorted(set(rng.integers(1, total, size=int(rng.integers(0, total))).tolist()) | {total}) if total > 1 else [1]
        cuts_b = sorted(set(rng.integers(1, total, size=int(rng.integers(0, total))).tolist()) | {total}) if total > 1 else [1]
        got = alignment.aligned_groups(np.array(cuts_a), np.array(cuts_b))
        assert got == brute_groups(cuts_a, cuts_b)


EDGE = [
    (1, "Hello world", 0), (2, None, 0), (3, "", 0), (4, "  spaced   out \t\n x", 0), (5, "<|endoftext|> </s> <s> <unk>", 0),
    (6, "wörld 😀 ünïcode ΑΒΓ", 0), (7, "Hello world", 0), (None, "Hello world", 0), (7, "other text", 0),
    (8, "word " * 5000, 0), (9, "ﬁ ligature normalised", 0),
]


def test_edge_texts_equal_brute_force(spark):
    got = sorted((tuple(r) for r in alignment.aligned(spark.createDataFrame(EDGE, SCHEMA)).collect()), key=str)
    assert got == brute(EDGE)
    zeros = {r[0]: r for r in got if r[1] == 0}
    assert 2 in zeros and 3 in zeros and zeros[2][-1] == ""


def test_table_equals_brute_force(spark):
    rows = [(r["doc_id"], r["text"], 0) for r in pq.read_table("/root/testdata/sf0.001/documents.parquet").to_pylist()[:120]]
    got = sorted((tuple(r) for r in alignment.aligned(spark.createDataFrame(rows, SCHEMA)).collect()), key=str)
    assert got == brute(rows)


def test_empty_table(spark):
    assert alignment.aligned(spark.createDataFrame([], SCHEMA)).count() == 0


TRICKY = [
    "plain words here", "  a b", "a   b c", "x\n y", "tab\t t", "it's 'll 're", "1 000 3a", "a ", "é ñ ŉ ſ Ǆ ŀ", "ﬁ a b", "▁ a ▁b",
    "\x1c a b", "é a ̈ b", "　 a b", "<0x41> </s> a", "", "word " * 300,
]


def test_parts_encoded_apart_equal_whole_texts():
    a, b, a_bytes, b_bytes, *_ = alignment._tokenizers(alignment.BYTE_BPE, alignment.PIECE_BPE)
    rng = np.random.default_rng(2)
    bits = [" ", " ", "  ", "\n", "th", "A", "1", "'s", "é", "中", "́", "▁", "<", ".", "Ǆ"]
    texts = TRICKY + ["".join(rng.choice(bits, size=int(rng.integers(1, 30)))) for _ in range(500)]
    memo = alignment._Parts(alignment.BYTE_BPE, alignment.PIECE_BPE)
    for _ in range(2):  # learned, then looked up
        n_a, n_b, n_groups, _, digests, _ = (x.to_pylist() for x in alignment._figures(texts, memo))
        for k, text in enumerate(texts):
            whole_a, whole_b, want = a.encode(" " + text, add_special_tokens=False).ids, b.encode(text), (" " + text).encode()
            if not text or b"".join(a_bytes[i] for i in whole_a) != want or b"".join(b_bytes[i] for i in whole_b) != want:
                assert (n_a[k], n_b[k], n_groups[k], digests[k]) == (0, 0, 0, ""), text
                continue
            ends = [list(np.cumsum([len(names[i]) for i in ids])) for names, ids in ((a_bytes, whole_a), (b_bytes, whole_b))]
            groups = brute_groups(*ends)
            said = ";".join(",".join(map(str, whole_a[i:p])) + "|" + ",".join(map(str, whole_b[j:q])) for i, p, j, q in groups)
            assert (n_a[k], n_b[k], n_groups[k]) == (len(whole_a), len(whole_b), len(groups)), text
            assert digests[k] == hashlib.sha256(said.encode()).hexdigest(), text


def test_shuffled_counts_equal_broadcast_counts(spark):
    docs = spark.createDataFrame(EDGE, SCHEMA)
    got = sorted((tuple(r) for r in alignment.aligned(docs, broadcast_pairs=0).collect()), key=str)
    assert got == brute(EDGE)
