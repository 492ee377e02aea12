import random
import re
from pathlib import Path

import numpy as np
import pytest

from llm import graph, jaccard, shared
from llm.shingles import shingle_sets

LOWER = {i: i + 32 for i in range(65, 91)}


def shingles(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    if not words:
        return frozenset()
    return frozenset([tuple(words)]) if len(words) < 5 else frozenset(tuple(words[i : i + 5]) for i in range(len(words) - 4))


def want(pairs, percent=80):
    sets = [(i, shingles(t)) for i, t in pairs]
    parent = list(range(len(sets)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in range(len(sets)):
        for b in range(a):
            common = len(sets[a][1] & sets[b][1])
            if sets[a][1] and 100 * common >= percent * len(sets[a][1] | sets[b][1]):
                parent[find(a)] = find(b)
    least = {}
    for k, (i, _) in enumerate(sets):
        least[find(k)] = min(i, least.get(find(k), i))
    return sorted((i, len(s), least[find(k)]) for k, (i, s) in enumerate(sets))


def corpus(seed, n, longest):
    """Texts of all sizes, many of them small changes of one another, and a passage that many share."""
    rng = random.Random(seed)
    word = lambda: rng.choice("abcdefghijklmnopqrstuvwxyz") + str(rng.randrange(400))
    passage = [word() for _ in range(30)]
    texts = []
    for i in range(n):
        if texts and rng.random() < 0.6:
            words = list(rng.choice(texts))
            for _ in range(rng.choice([0, 1, 1, 2, 3, 5])):
                at, kind = rng.randrange(len(words) + 1), rng.randrange(3)
                words[at : at + (kind > 0)] = [word()] if kind < 2 else []
        else:
            words = [word() for _ in range(rng.randrange(1, longest))]
            if rng.random() < 0.3:
                words[:0] = passage
        texts.append(words)
    return [(1000 - i, " ".join(w)) for i, w in enumerate(texts)]


@pytest.mark.parametrize("seed, n, longest, blocks", [(1, 300, 14, 1_000_000), (2, 250, 120, 1_000_000), (3, 200, 60, 400)])
def test_components_equal_all_pairs(docs, seed, n, longest, blocks):
    pairs = corpus(seed, n, longest)
    found = jaccard.near_duplicates(docs(pairs), block_shingles=blocks)
    assert sorted(map(tuple, found.collect())) == want(pairs)


def test_nulls_copies_and_long_texts(docs):
    long = " ".join(f"w{i}" for i in range(60_000))
    pairs = [(5, None), (6, ""), (7, " \n"), (8, "One two"), (3, "one\ttwo"), (9, "two one"), (11, long), (12, long + " tail"), (13, "x" * 9_000_000)]
    pairs += [(i, "the same text of more than five words") for i in range(20, 60)]
    found = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard.near_duplicates(docs(pairs)).collect()}
    assert [found[i] for i in (5, 6, 7)] == [(0, 5), (0, 6), (0, 7)]
    assert found[8] == found[3] == (1, 3) and found[9] == (1, 9) and found[13] == (1, 13)
    assert found[11] == (59_996, 11) and found[12] == (59_997, 11)
    assert {found[i] for i in range(20, 60)} == {(4, 20)}
    odd = docs([(None, "a b c d e f"), (4, "a b c d e f"), (None, "lone text with five words"), (2, "q"), (2, "a b c d e f g"), (2, "q")])
    got = sorted(map(str, (tuple(r) for r in jaccard.near_duplicates(odd, percent=50).collect())))
    assert got == sorted(map(str, [(None, 2, 2), (4, 2, 2), (None, 1, None), (2, 1, 2), (2, 3, 2), (2, 1, 2)]))
    assert jaccard.near_duplicates(docs([])).count() == 0


def test_one_of_each_keeps_the_smallest_id(docs, rows):
    pairs = corpus(4, 80, 40)
    frame = docs(pairs).withColumnRenamed("lang", "component_id")
    kept = jaccard.one_of_each(frame)
    assert kept.columns == frame.columns
    assert rows(kept, "doc_id") == sorted(({(c,) for _, _, c in want(pairs)}), key=lambda r: str(r[0]))


def test_every_linked_pair_shares_an_entry():
    """The pigeonhole bound itself, for tiny and middling sets with as many differences as a link allows."""
    rng = np.random.default_rng(5)
    for n in [*range(1, 40), 60, 100, 173, 250]:
        for _ in range(25):
            a = np.unique(rng.integers(0, 2**63, n, dtype=np.uint64) * np.uint64(2))
            drop = rng.integers(0, len(a) // 5 + 1)
            common = rng.permutation(a)[drop:]
            room = 100 * len(common) // 80 - len(a)
            more = rng.integers(0, 2**63, max(0, room), dtype=np.uint64)
            b = np.unique(np.concatenate([common, more]))
            if 180 * len(common) < 80 * (len(a) + len(b)) or not len(b):
                continue
            values, offsets = np.concatenate([a, b]), np.array([0, len(a), len(a) + len(b)])
            entry, owner = jaccard.index_entries(values, offsets)
            assert set(entry[owner == 0]) & set(entry[owner == 1]), (len(a), len(b), len(common))


def test_shingles_of_a_text_do_not_depend_on_its_neighbours():
    texts = ["a b c d e f", "", "A B c D e F", "x", "tail of one", "a b c d e f"]
    data = np.frombuffer("".join(texts).encode(), np.uint8)
    offsets = np.concatenate([[0], np.cumsum([len(t) for t in texts])])
    values, own = shingle_sets(data, offsets)
    sets = [tuple(values[own[i] : own[i + 1]]) for i in range(len(texts))]
    assert sets[0] == sets[2] == sets[5] and [len(s) for s in sets] == [2, 0, 2, 1, 1, 2]
    assert list(sets[0]) == sorted(sets[0])


def test_components_of_a_graph(spark, rows):
    rng = random.Random(1)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(200)] + [(i, i + 1) for i in range(400, 460)] + [(7, 7)]
    found = dict(rows(graph.components(spark.createDataFrame(edges, "a long, b long"))))
    label = {x: x for e in edges for x in e}
    for _ in range(400):
        for a, b in edges:
            label[a] = label[b] = min(label[a], label[b])
    assert found == {x: r for x, r in label.items() if any(x in e and e[0] != e[1] for e in edges)}
    assert graph.components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_one_of_each_keeps_rows_without_id_and_repeated_ids(docs):
    a, b, c = (" ".join(f"{x}{i}" for i in range(40)) for x in "abc")
    near = a + " more"
    pairs = [(1, a), (2, near), (2, b), (None, c), (None, c + " more"), (None, near), (None, None), (None, ""), (7, ""), (8, None), (9, "x y z"), (9, "x y z")]
    got = [(r.doc_id, r.text) for r in jaccard.one_of_each(docs(pairs)).collect()]
    assert len(got) == 8 and set(got) - {(None, c), (None, c + " more")} == {(1, a), (2, b), (None, None), (None, ""), (7, ""), (8, None), (9, "x y z")}
    assert len({(None, c), (None, c + " more")} & set(got)) == 1


def written(spark):
    """Bytes of all files in the shared folder."""
    return sum(p.stat().st_size for p in Path(shared.shared_folder(spark).removeprefix("file:")).rglob("*") if p.is_file())


def unrelated(n, words, prefix=""):
    rng = random.Random(n)
    return [(i, prefix + " ".join(str(rng.randrange(10**6)) for _ in range(words))) for i in range(n)]


def test_entries_are_not_stored(spark, docs):
    pairs = unrelated(200, 600)
    shared.shared_folder(spark)
    before = written(spark)
    assert jaccard.near_duplicates(docs(pairs)).count() == 200
    assert written(spark) - before < sum(len(t) for _, t in pairs) / 4


def test_only_texts_of_candidates_are_dealt_out(docs, monkeypatch):
    seen, marked = [], jaccard.marked

    def watched(rows, keys, columns, name):
        out = marked(rows, keys, columns, name)
        seen.append((keys.count(), out.count(), out.filter(f"`{name}`").count()))
        return out

    monkeypatch.setattr(jaccard, "marked", watched)
    pairs = unrelated(300, 60)
    pairs += [(1000 + i, pairs[i][1] + " tail") for i in range(5)]
    assert sorted(r.doc_id for r in jaccard.one_of_each(docs(pairs)).collect()) == list(range(300))
    assert [s[:2] for s in seen] == [(10, 305), (5, 305), (10, 305)] and all(least <= s <= 40 for least, (*_, s) in zip((10, 10, 10), seen))


def test_a_passage_of_many_texts_connects_none_of_them(docs, monkeypatch):
    groups, grouped = [], jaccard._grouped

    def watched(members, block_shingles):
        groups.append(members.count())
        return grouped(members, block_shingles)

    monkeypatch.setattr(jaccard, "_grouped", watched)
    pairs = unrelated(200, 50, "one line of boilerplate that very many of these long texts begin with ")
    pairs.append((900, pairs[7][1] + " tail"))
    found = {r.doc_id: r.component_id for r in jaccard.near_duplicates(docs(pairs)).collect()}
    assert found == {i: i for i in range(200)} | {900: 7}
    assert groups[0] < 20


def test_every_linked_pair_shares_an_entry_whatever_is_common():
    rng = np.random.default_rng(6)
    for n in [*range(2, 60, 3), 173, 250]:
        for _ in range(15):
            a = np.unique(rng.integers(0, 2**63, n, dtype=np.uint64) * np.uint64(2))
            both = rng.permutation(a)[rng.integers(0, len(a) // 5 + 1) :]
            b = np.unique(np.concatenate([both, rng.integers(0, 2**63, max(0, 100 * len(both) // 80 - len(a)), dtype=np.uint64)]))
            if 180 * len(both) < 80 * (len(a) + len(b)):
                continue
            common = np.sort(rng.permutation(np.union1d(a, b))[: rng.integers(0, n + 1)])
            common = common, rng.integers(1, 20, len(common)).astype(np.uint8)
            values, offsets = np.concatenate([a, b]), np.array([0, len(a), len(a) + len(b)])
            entry, owner = jaccard.index_entries(values, offsets, common=common)
            assert set(entry[owner == 0]) & set(entry[owner == 1]), (len(a), len(b), len(both))


def test_marked_rows_are_all_that_match_and_few_others(spark):
    rows = spark.createDataFrame([(i, None if i % 3 else i) for i in range(2000)] + [(None, None)], "a long, b long")
    keys = spark.createDataFrame([(i, None if i % 3 else i) for i in range(0, 2000, 50)] + [(None, None)], "a long, b long")
    found = shared.marked(rows, keys, ["a", "b"], "hit").filter("hit").collect()
    assert {r.a for r in found} >= {None, *range(0, 2000, 50)} and len(found) < 60
    none = shared.marked(rows, keys.limit(0), ["a", "b"], "hit")
    assert none.columns == ["a", "b", "hit"] and none.filter("NOT hit").count() == 2001
