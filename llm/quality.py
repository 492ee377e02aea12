"""Quality rules as weak supervision.

Every rule votes good (1), bad (-1) or abstains (0) on the measurements of a text. The votes of the
whole corpus are counted by pattern, expectation-maximisation over those counts estimates how often
each rule is right on good and on bad texts, and the posterior probability of "good" decides.

The number of patterns is at most 3 to the power of the number of rules, whatever the corpus size.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from math import exp, log

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from llm.shared import SPACE, words

WINDOW = 5
MIN_WORDS = 10
MAX_REPEAT_PERCENT = 20
METRICS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_upper")


@dataclass(frozen=True)
class Rule:
    """Conditions on the measurements under which a rule votes; where neither holds it abstains."""

    name: str
    good: str
    bad: str

    def vote(self) -> Column:
        return F.when(F.expr(self.bad), -1).when(F.expr(self.good), 1).otherwise(0)


RULES = (
    Rule("plain words", "100 * n_symbols <= n_words AND 5 * n_upper <= word_chars AND 10 * n_repeat_words <= n_words", "false"),
    Rule("plain lines", "n_dup_lines = 0 AND 10 * n_symbols <= n_words AND 2 * n_upper <= word_chars", "10 * n_dup_lines > 3 * n_lines"),
    Rule("symbols", "false", "10 * n_symbols > n_words"),
    Rule("repeats", "false", "5 * n_repeat_words > n_words"),
    Rule("capitals", "false", "2 * n_upper > word_chars"),
    Rule("word length", "false", "word_chars > 15 * n_words OR word_chars < 2 * n_words"),
)


@dataclass(frozen=True)
class VoteModel:
    """Prior probability of a good text, and for each rule how often its votes are right."""

    prior: float
    accuracy: tuple[float, ...]

    def weights(self) -> list[float]:
        """Log odds that a vote of each rule moves."""
        return [log(a / (1 - a)) for a in self.accuracy]

    def log_odds(self, votes: Sequence[int]) -> float:
        return log(self.prior / (1 - self.prior)) + sum(v * w for v, w in zip(votes, self.weights()))

    def posterior(self, votes: Column) -> Column:
        odds = F.lit(log(self.prior / (1 - self.prior)))
        for i, weight in enumerate(self.weights()):
            odds = odds + votes[i] * F.lit(weight)
        return F.lit(1.0) / (F.lit(1.0) + F.exp(-odds))


def _repeated_words(hashes: Column, count: Column) -> Column:
    """Words covered by windows whose hash occurs again, from the window hashes in text order."""

    def covered(ordered: Column) -> Column:
        last = F.size(ordered) - 1

        def again(i: Column) -> Column:
            own = ordered[i]["h"]
            before = F.when(i > 0, ordered[F.greatest(i - 1, F.lit(0))]["h"] == own)
            after = F.when(i < last, ordered[F.least(i + 1, last)]["h"] == own)
            return F.when(F.coalesce(before, F.lit(False)) | F.coalesce(after, F.lit(False)), ordered[i]["p"])

        return F.sort_array(F.filter(F.transform(F.sequence(F.lit(0), last), again), lambda p: p.isNotNull()))

    def length(starts: Column) -> Column:
        last = F.size(starts) - 1
        step = lambda i: F.when(i == last, F.lit(WINDOW)).otherwise(
            F.least(F.lit(WINDOW), starts[F.least(i + 1, last)] - starts[i])
        )
        return F.aggregate(F.transform(F.sequence(F.lit(0), last), step), F.lit(0), lambda a, b: a + b)

    pairs = F.arrays_zip(hashes.alias("h"), F.sequence(F.lit(0), count - 1).alias("p"))
    pairs = F.transform(pairs, lambda x: F.struct(x["h"].alias("h"), x["p"].alias("p")))
    starts = F.transform(F.array(F.sort_array(pairs)), covered)
    return F.transform(starts, length)[0]


def measured(docs: DataFrame, text: str = "text") -> DataFrame:
    """docs with the measurements of METRICS added (long), replacing columns of those names.

    A null text has no words and lines: all measurements are 0. Windows are compared by a 64-bit hash
    within one text. Everything works on one row, so there is no shuffle and no skew.
    """
    own = F.col(f"`{text}`")
    lines = F.filter(F.split(own, "\n", -1), lambda line: line.rlike(r"[^\x20\x09-\x0D]"))
    out = docs.withColumns({"_words": words(own), "_lines": F.coalesce(lines, F.array().cast("array<string>"))})
    count = F.size("_words") - (WINDOW - 1)
    parts = [F.slice("_words", i + 1, count) for i in range(WINDOW)]
    hashes = F.when(count > 0, F.transform(F.arrays_zip(*parts), lambda w: F.xxhash64(w)))
    out = out.withColumn("_windows", F.coalesce(hashes, F.array().cast("array<bigint>")))
    windows = F.size("_windows")
    repeats = F.when(F.size(F.array_distinct("_windows")) < windows, _repeated_words(F.col("_windows"), windows))
    metrics = {
        "n_words": F.size("_words"),
        "word_chars": F.char_length(F.array_join("_words", "")),
        "n_symbols": F.coalesce(F.char_length(F.regexp_replace(own, r"[^#*$%&|<>]+", "")), F.lit(0)),
        "n_dup_lines": F.size("_lines") - F.size(F.array_distinct("_lines")),
        "n_repeat_words": F.coalesce(repeats, F.lit(0)),
        "n_lines": F.size("_lines"),
        "n_upper": F.coalesce(F.char_length(F.regexp_replace(own, r"[^A-Z]+", "")), F.lit(0)),
    }
    return out.withColumns({k: v.cast("long") for k, v in metrics.items()}).drop("_words", "_lines", "_windows")


def base_failed() -> Column:
    n_words, repeated = F.col("n_words"), F.col("n_repeat_words")
    return (n_words < MIN_WORDS) | (100 * repeated > MAX_REPEAT_PERCENT * n_words)


def vote_patterns(measurements: DataFrame, rules: Sequence[Rule] = RULES) -> dict[tuple[int, ...], int]:
    """Rows of each vote pattern; counted before the shuffle, so at most 3 ** len(rules) rows a task."""
    votes = [rule.vote().alias(f"v{i}") for i, rule in enumerate(rules)]
    counts = measurements.select(votes).groupBy(*[f"v{i}" for i in range(len(rules))]).count().collect()
    return {tuple(r[: len(rules)]): r["count"] for r in counts}


def fit(patterns: dict[tuple[int, ...], int], rules: Sequence[Rule] = RULES, prior: float = 0.5, rounds: int = 50) -> VoteModel:
    """Expectation-maximisation over pattern counts; with no rows the starting values stay.

    Rules that only object start as right nine times in ten, rules that also approve (a sign that most
    texts show) as right eight times in ten. Each rule's start weighs as much as a tenth of its votes, so
    a rule without votes keeps it, and accuracies stay between one half and 0.99.
    """
    start = [0.9 if rule.good == "false" else 0.8 for rule in rules]
    model = VoteModel(prior, tuple(start))
    for _ in range(rounds):
        right, cast = [0.0] * len(rules), [0.0] * len(rules)
        for votes, n in patterns.items():
            good = 1 / (1 + exp(-max(-500.0, min(500.0, model.log_odds(votes)))))
            for i, v in enumerate(votes):
                if v:
                    right[i] += n * (good if v > 0 else 1 - good)
                    cast[i] += n
        mean = [(r + a * (1 + 0.1 * c)) / (1 + 1.1 * c) for r, c, a in zip(right, cast, start)]
        model = VoteModel(prior, tuple(min(0.99, max(0.5, m)) for m in mean))
    return model


def judged(measurements: DataFrame, model: VoteModel, threshold: float = 0.5, rules: Sequence[Rule] = RULES) -> DataFrame:
    """Add base_failed, the votes, quality (posterior probability of good) and kept."""
    out = measurements.withColumns({"base_failed": base_failed(), "votes": F.array(*[r.vote() for r in rules])})
    out = out.withColumn("quality", model.posterior(F.col("votes")))
    return out.withColumn("kept", ~F.col("base_failed") & (F.col("quality") >= threshold))


def good_documents(docs: DataFrame, text: str = "text") -> DataFrame:
    """The rows of docs that the rules keep, with the columns of docs."""
    model = fit(vote_patterns(measured(docs.select(F.col(f"`{text}`").alias("text")))))
    out = judged(measured(docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"), F.col(f"`{text}`").alias("_text")), "_text"), model)
    # a filter would be pushed below the measurements and work them out again for each use in its condition
    kept = F.when(F.col("kept"), F.array("_row")).otherwise(F.filter(F.array("_row"), lambda r: F.lit(False)))
    return out.select(F.explode(kept).alias("_row")).select("_row.*")
