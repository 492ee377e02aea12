import re

import pytest
from pyspark.sql import functions as F

from llm import licenses

KNOWN = licenses.prepared()


def brute(text, threshold=0.8):
    found = []
    for unit in dict.fromkeys([] if text is None else re.split(r"\r?\n", text) + re.split(r"\r?\n[ \t]*\r?\n", text) + [text]):
        words = re.findall("[a-z0-9]+", re.sub("[A-Z]", lambda m: m[0].lower(), unit))
        own = {f"{a} {b}" for a, b in zip(words, words[1:])}
        best = max((2 * len(own & set(t)) / (len(own) + len(t)), name) for name, t in KNOWN)
        if best[0] >= threshold:
            found.append(best)
    return (max(found)[1], max(found)[0], len(found)) if found else (None, None, 0)


TEXTS = [
    None, "", "\n\n", "prose about licenses and software, by and large", "Intro.\nLicensed under CC BY-NC 4.0.\nOutro.",
    "LICENSED UNDER THE APACHE LICENSE, VERSION 2.0!!!", "licensed   under the\tApache licence version 2.0", "Licensed under the Apache\nLicense, Version 2.0.",
    *[text for texts in licenses.TEMPLATES.values() for text in texts], *[" ".join(t.split()[2:]) for ts in licenses.TEMPLATES.values() for t in ts],
    *[t.replace(" ", "\n", 3).replace("\n", " extra ", 1) for ts in licenses.TEMPLATES.values() for t in ts],
    "Released under the MIT License.\r\nThis work is licensed under the GNU General Public License, version 3.\n" * 2, "word " * 60_000 + "\nReleased under the MIT License.",
    "überall Released under the MIT License. überall", "Releaſed under the MIT Licenſe.", "licensed under", "Licensed",
]


def test_best_license_equals_plain_comparison(docs):
    frame = docs(list(enumerate(TEXTS))).withColumn("license", F.lit("mine")).withColumn("dice", F.lit("mine"))
    found = licenses.scanned(frame).orderBy("doc_id").collect()
    assert [(r.license, r.dice, r.n_notices) for r in found] == [brute(t) for t in TEXTS]
    assert sum(r.license is not None for r in found) > 30
    assert licenses.scanned(docs([])).count() == 0


def test_every_template_is_its_own_best_match(docs):
    pairs = [(i, t) for i, t in enumerate(t for name in sorted(licenses.TEMPLATES) for t in licenses.TEMPLATES[name])]
    names = [name for name in sorted(licenses.TEMPLATES) for _ in licenses.TEMPLATES[name]]
    found = licenses.scanned(docs(pairs)).orderBy("doc_id").collect()
    assert [(r.license, r.dice) for r in found] == [(n, 1.0) for n in names]


@pytest.mark.parametrize("threshold", [0.6, 0.8, 0.95])
def test_no_match_lacks_a_signal_word(threshold):
    signal = set(licenses.signal_words(KNOWN, threshold))
    for _, bigrams in KNOWN:
        untouched = [b for b in bigrams if not signal & set(b.split())]
        assert len(untouched) < threshold / (2 - threshold) * len(bigrams)
    with pytest.raises(ValueError):
        licenses.prepared({"x": ("one",)})
