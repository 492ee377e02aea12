import re

from pyspark.sql import functions as F

from llm import quality

TEXTS = [
    None, "", " \n\t ", "one", "one two three four", "a b c d e", "a b c d e a b c d e", "x " * 40, "a b c",
    "line one here\nother line\nline one here\n\n \nline one here\r", "# * $ % & | < > ##", "SHOUT " * 30 + "!",
    "überall öde Straße " * 9, "w " * 3 + "\x1cword\x85next", " ".join(f"w{i}" for i in range(3000)), "a b c d e f " + "z " * 4 + "a b c d e f",
]


def measure(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    seen, covered = {}, set()
    for i in range(len(words) - 4):
        seen.setdefault(tuple(words[i : i + 5]), []).append(i)
    for places in seen.values():
        if len(places) > 1:
            covered |= {p + k for p in places for k in range(5)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return (
        len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered),
        len(lines), len(re.findall("[A-Z]", text)),
    )


def test_measurements_equal_plain_counts(docs):
    found = quality.measured(docs(list(enumerate(TEXTS)))).orderBy("doc_id").collect()
    assert [tuple(r[m] for m in quality.METRICS) for r in found] == [measure(t) for t in TEXTS]


def test_estimation_tells_good_rules_from_noise():
    rules = [quality.Rule("a", "true", "false"), quality.Rule("b", "true", "false"), quality.Rule("noise", "true", "false")]
    patterns = {(1, 1, 1): 450, (1, 1, -1): 450, (-1, -1, 1): 50, (-1, -1, -1): 50}
    model = quality.fit(patterns, rules)
    assert model.accuracy[0] > 0.9 and model.accuracy[1] > 0.9 and model.accuracy[2] < 0.7
    assert model.log_odds((1, 1, -1)) > 0 > model.log_odds((-1, -1, 1))
    assert quality.fit({}, rules).accuracy == (0.8, 0.8, 0.8)


def test_posterior_equals_the_model(docs):
    pairs = list(enumerate(TEXTS))
    found = quality.measured(docs(pairs))
    model = quality.fit(quality.vote_patterns(found))
    for row in quality.judged(found, model).collect():
        assert abs(row.quality - 1 / (1 + 2.718281828459045 ** -model.log_odds(row.votes))) < 1e-9
        assert row.kept == (not row.base_failed and row.quality >= 0.5)


def test_rejected_documents_go(docs, rows):
    good = " ".join(f"word{i} reads well" for i in range(30))
    clashing = docs([(1, good), (2, "# " * 50 + good.upper()), (3, None), (4, "x y " * 40), (5, good + " end"), (6, good)])
    clashing = clashing.withColumn("n_words", F.lit("mine")).withColumn("_row", F.lit(1)).withColumn("a.b", F.lit(2))
    kept = quality.good_documents(clashing)
    assert kept.columns == clashing.columns
    assert rows(kept, "doc_id", "n_words") == [(1, "mine"), (5, "mine"), (6, "mine")]
    assert quality.good_documents(docs([])).count() == 0
