import fnmatch
import random
import re

import pytest
from pyspark.sql import functions as F

from llm import urls


def fits(host_glob, path_glob, host, path):
    host_ok = re.fullmatch(fnmatch.translate(host_glob).replace("(?s:", "(?s:"), host) is not None
    return host_ok and re.fullmatch(fnmatch.translate(path_glob), path) is not None


@pytest.mark.parametrize("seed", range(4))
def test_automaton_equals_one_match_at_a_time(seed):
    rng = random.Random(seed)
    text = lambda letters, n: "".join(rng.choice(letters) for _ in range(rng.randrange(n)))
    globs = [(text("ab.*", 7), text("/ab*", 7)) for _ in range(60)] + [("*", "*"), ("", ""), ("*a*a*a*", "*/b")]
    places = [(text("ab.", 12), text("/ab", 12)) for _ in range(400)]
    found = urls.GlobAutomaton(globs).matches([f"{h}\0{p}".encode() for h, p in places])
    assert found.shape == (400, 63)
    for row, (h, p) in zip(found, places):
        assert row.tolist() == [fits(a, b, h, p) for a, b in globs]
    assert urls.GlobAutomaton(globs).matches([]).shape == (0, 63)


CASES = [
    ("http://Sub.Example.ORG/es/1", "sub.example.org", "/es/1", "example.org/es/", "block"),
    ("https://example.org/en/17?q=/es/", "example.org", "/en/17", "example.org/en/1", "block"),
    ("https://example.org/en/2", "example.org", "/en/2", "org/", "allow"),
    ("https://notexample.org/es/", "notexample.org", "/es/", "org/", "allow"),
    ("https://example.org", "example.org", "", None, "allow"),
    ("https://example.org?x=/es/", "example.org", "", None, "allow"),
    ("http://a.com/fr/x#y", "a.com", "/fr/x", "com/fr/", "allow"),
    ("http://a.com/de/", "a.com", "/de/", "com/de/", "block"),
    ("http://com.net/de/", "com.net", "/de/", None, "allow"),
    ("http://evil.net/x.org/", "evil.net", "/x.org/", None, "allow"),
    ("http://big-casino.net/", "big-casino.net", "/", None, "block"),
    ("http://fine.net/casino", "fine.net", "/casino", None, "allow"),
    ("http://casino.org/x", "casino.org", "/x", "org/", "allow"),
    ("x://ÄB.com/fr/é://z", "Äb.com", "/fr/é://z", "com/fr/", "allow"),
    ("no scheme.org/", "", "", None, "allow"),
    ("", "", "", None, "allow"),
    (None, "", "", None, "allow"),
    ("http://a.org/" + "x" * 20_000, "a.org", "/" + "x" * 20_000, "org/", "allow"),
    ("http://a\n.org/y", "a\n.org", "/y", "org/", "allow"),
]


def test_verdicts(spark):
    frame = spark.createDataFrame([(i, c[0], "mine") for i, c in enumerate(CASES)], "page_id long, url string, verdict string")
    found = urls.judged(frame).orderBy("page_id").collect()
    assert [(r.host, r.path, r.rule, r.verdict) for r in found] == [c[1:] for c in CASES]
    assert urls.judged(frame.limit(0)).count() == 0


def test_parts_are_native_expressions(spark):
    host, path = urls.url_parts(F.col("url"))
    frame = spark.createDataFrame([("s://U@H:8/p/?q#f",)], "url string").select(host.alias("h"), path.alias("p"))
    assert tuple(frame.first()) == ("u@h:8", "/p/")
