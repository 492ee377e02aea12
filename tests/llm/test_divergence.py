import random

from hypothesis import given, settings
from hypothesis import strategies as st

from llm import divergence
from llm.divergence import Transducer

SCHEMA = "doc_id long, text string, lang string, source string, other string"


@settings(max_examples=60, deadline=None)
@given(st.sets(st.text(min_size=1, max_size=12), max_size=60))
def test_transducer_gives_lexicographic_ordinals(words):
    encoded = sorted(w.encode("utf-8") for w in words)
    fst = Transducer.from_bytes(Transducer.build(encoded).to_bytes())
    assert [fst.ordinal(w) for w in encoded] == list(range(len(encoded)))
    for w in ("zz-missing", "", "a" * 30):
        if w.encode() not in encoded:
            assert fst.ordinal(w.encode()) == -1


def test_transducer_is_minimal_on_shared_suffixes():
    words = sorted(f"{a}{b}ing".encode() for a in "abcdefgh" for b in "xyz")
    fst = Transducer.build(words)
    assert len(fst.final) < 20  # 24 words of 5 letters: suffix states are shared
    long = [b"q" * 20_000, b"r"]
    assert Transducer.build(long).ordinal(b"q" * 20_000) == 0


def brute(rows, min_docs):
    """All parts by the contract's words, in plain Python."""
    import re
    from collections import Counter

    pat = re.compile(divergence.TERM)
    low = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    docs = [((l or ""), (s or ""), pat.findall((t or "").translate(low))) for _, t, l, s, _ in rows]
    out = set()
    for lang in {d[0] for d in docs}:
        df = Counter(t for l, _, ts in docs if l == lang for t in set(ts))
        kept = sorted((t for t, n in df.items() if n >= min_docs), key=lambda t: t.encode())
        v = len(kept)
        sources = sorted({s for l, s, _ in docs if l == lang})
        count = {s: Counter(t for l, x, ts in docs if l == lang and x == s for t in ts if t in df and df[t] >= min_docs) for s in sources}
        whole = sum(count.values(), Counter())
        share = lambda c: {t: 1 + 10**9 * (c[t] + 5) // (sum(c[k] for k in kept) + 5 * v) for t in kept}
        p = {s: share(count[s]) for s in sources}
        q = share(whole)
        for s in sources:
            pairs = sorted(((sum(abs(p[s][t] - p[o][t]) for t in kept), o) for o in sources if o != s), key=lambda x: (-x[0], x[1].encode()))
            out |= {(lang, s, "pair", o, val, i + 1) for i, (val, o) in enumerate(pairs)}
            terms = sorted(((p[s][t] - q[t], t) for t in kept if count[s][t] > 0 and p[s][t] > q[t]), key=lambda x: (-x[0], x[1].encode()))
            out |= {(lang, s, "term", t, val, i + 1) for i, (val, t) in enumerate(terms[:50])}
    return out


def fixture():
    rng = random.Random(5)
    vocab = ["alpha", "Beta", "gamma", "délta", "ÉPS", "zeta", "eta", "theta"]
    rows = []
    for i in range(120):
        words = rng.choices(vocab, k=rng.randint(0, 30))
        rows.append((i, " ".join(words) + " 12,x!y", rng.choice(["en", "de", None]), rng.choice(["a", "b", "c", None]), "z"))
    rows += [(500, None, "en", "a", "z"), (501, "", "fr", "solo", "z"), (502, "only once words", "fr", "solo", "z"), (1, "alpha", "en", "a", "z")]
    return rows


def test_parts_equal_brute_force_on_both_recount_paths(spark):
    rows = fixture()
    frame = spark.createDataFrame(rows, SCHEMA)
    want = brute(rows, 10)
    for limit in (divergence.BROADCAST_BYTES, 0):
        got = {tuple(r) for r in divergence.audited(frame, min_docs=10, broadcast_bytes=limit).collect()}
        assert got == want


def test_empty_table_and_language_without_terms(spark):
    assert divergence.audited(spark.createDataFrame([], SCHEMA)).count() == 0
    rows = [(1, "a b", "xx", "s1", None), (2, None, "xx", "s2", None), (3, "...", None, None, None)]
    got = {tuple(r) for r in divergence.audited(spark.createDataFrame(rows, SCHEMA), min_docs=5).collect()}
    assert got == {("xx", "s1", "pair", "s2", 0, 1), ("xx", "s2", "pair", "s1", 0, 1)}


def test_vocabulary_larger_than_a_batch_is_one_transducer(spark):
    """A language's terms reach its task in batches of rows: all of them make one transducer."""
    rows = fixture()
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, "3")
    try:
        got = [tuple(r) for r in divergence.audited(spark.createDataFrame(rows, SCHEMA), min_docs=10).collect()]
    finally:
        spark.conf.set(name, before)
    assert sorted(got) == sorted(brute(rows, 10))


def test_words_of_bytes_are_the_terms():
    import re

    texts = ["Alpha, ÉPS\x85x\xa0Y zZ_a`b{c|d~e\x7ff@g[h^i", "İ ſ K 中文12 a\u2028b\u3000c", "", " 12 "]
    for text in texts:
        lowered = text.translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))
        assert [w.decode() for w in divergence._words(text.encode())] == re.findall(divergence.TERM, lowered)


def test_recount_folds_before_the_transducer(monkeypatch):
    """A term of a language passes the transducer once per fold, whatever the number of documents."""
    import pyarrow as pa

    class Value:
        value = Transducer.build([b"alpha", b"beta"]).to_bytes()

    calls = []
    ordinal = Transducer.ordinal
    monkeypatch.setattr(Transducer, "ordinal", lambda self, word: calls.append(word) or ordinal(self, word))
    texts = [x.encode() for x in ["Alpha alpha gamma", "BETA délta"]] * 25
    rows = pa.RecordBatch.from_pydict({"lang": ["en"] * 50, "source": ["a", "b"] * 25, "text": texts})
    found = divergence._streamed(iter([rows[:20], rows[20:]]), {"en": Value})
    got = sorted(tuple(r.values()) for f in found for r in f.to_pylist())
    assert got == [("en", "a", 0, 50), ("en", "b", 1, 25)]
    assert sorted(calls) == sorted(["alpha".encode(), b"gamma", b"beta", "délta".encode()])


def test_shares_join_only_the_counts_and_the_siblings(spark):
    """The plan holds no join of the grid with the language's shares on p > q."""
    plan = divergence.audited(spark.createDataFrame(fixture(), SCHEMA), min_docs=10)._jdf.queryExecution().optimizedPlan().toString()
    assert not [line for line in plan.splitlines() if "Join" in line and "p#" in line and "> q#" in line]
