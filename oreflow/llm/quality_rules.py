"""Quality rules as weak supervision.

Every rule votes good, bad, or abstains. Expectation-maximisation over the counts of vote
patterns estimates how often each rule votes what for good and for bad documents, and the
posterior probability of being good decides, in place of a filter that every rule must pass.

Rules look at words ``[^\\x20\\x09-\\x0D]+``. A null or empty text has no words; it fails the base
test (fewer than 50 words, or more than half of the words in repeated windows of three words) and
is not kept. Each row is judged by itself, so repeated rows get equal results and null ids are
kept as they are. An empty table gives an empty result.

Only DataFrame functions are used; the driver sees the counts of at most ``3 ** len(RULES)``
vote patterns.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from oreflow.llm.common import SPACE_RUN, SPACES, documents_only
from oreflow.session import materialise

# Fixed values of the base test.
LEAST_WORDS, MOST_REPEATED = 50, 50
SYMBOLS = r"[#*$%&|<>]"


def text_metrics(docs: DataFrame) -> DataFrame:
    """(doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, ...) of every row, from whole texts."""
    stripped = documents_only(docs).select("doc_id", "text", F.btrim("text", F.lit(SPACES)).alias("stripped"))
    split = stripped.select(
        "doc_id",
        "text",
        F.when(F.col("stripped") == "", F.array().cast("array<string>")).otherwise(F.split("stripped", SPACE_RUN)).alias("words"),
        F.filter(F.split("text", "\n"), lambda line: F.btrim(line, F.lit(SPACES)) != "").alias("lines"),
    )
    words = F.col("words")
    counted = split.select(
        "doc_id",
        F.size("words").alias("n"),
        F.length(F.regexp_replace("text", SPACE_RUN, "")).cast("long").alias("word_chars"),
        F.regexp_count("text", F.lit(SYMBOLS)).cast("long").alias("n_symbols"),
        F.regexp_count("text", F.lit(r"\p{Lu}")).cast("long").alias("n_upper"),
        F.regexp_count("text", F.lit(r"[\p{L}\p{M}]")).cast("long").alias("n_letters"),
        F.regexp_count("text", F.lit(r"[!?|]")).cast("long").alias("n_marks"),
        F.size("lines").cast("long").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.size(F.array_distinct("words")).cast("long").alias("n_distinct"),
        F.when(
            F.size("words") > 2,
            F.slice(
                F.transform(words, lambda w, i: F.xxhash64(w, F.get(words, i + 1), F.get(words, i + 2))), F.lit(1), F.size("words") - 2
            ),
        )
        .otherwise(F.array().cast("array<long>"))
        .alias("windows"),
    )
    # A window's hash and its place share one long: the place takes as many low bits as the text needs.
    repeats = F.size("windows") > F.size(F.array_distinct("windows"))
    bits = F.length(F.bin("n"))
    keyed = F.transform(
        "windows", lambda h, i: F.call_function("shiftleft", h, F.col("bits")).bitwiseOR(i.cast("long"))
    )
    flagged = counted.withColumns({"bits": bits, "repeats": repeats})
    ordered = flagged.withColumn("ordered", F.when(F.col("repeats"), F.sort_array(keyed))).drop("windows")
    line = F.col("ordered")

    def hashed(x: Column) -> Column:
        return F.call_function("shiftright", x, F.col("bits"))

    twice = F.filter(
        "ordered",
        lambda x, i: F.coalesce(
            (hashed(x) == hashed(F.get(line, i + 1))) | ((i > 0) & (hashed(x) == hashed(F.get(line, F.greatest(i - 1, F.lit(0)))))),
            (i > 0) & (hashed(x) == hashed(F.get(line, F.greatest(i - 1, F.lit(0))))),
        ),
    )
    places = ordered.withColumn("places", F.transform(twice, lambda x: x.bitwiseAND(F.call_function("shiftleft", F.lit(1).cast("long"), F.col("bits")) - 1)))
    covered = F.array_distinct(F.flatten(F.transform("places", lambda p: F.array(p, p + 1, p + 2))))
    return places.select(
        "doc_id",
        F.col("n").cast("long").alias("n_words"),
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        F.coalesce(F.when(F.col("repeats"), F.size(covered)), F.lit(0)).cast("long").alias("n_repeat_words"),
        "n_upper",
        "n_letters",
        "n_marks",
        "n_lines",
        "n_distinct",
    )


@dataclass(frozen=True)
class Rule:
    """Votes bad where ``bad`` holds, else good where ``good`` holds, else abstains."""

    name: str
    good: Column
    bad: Column

    def vote(self) -> Column:
        return F.when(self.bad, -1).when(self.good, 1).otherwise(0).cast("int")


def production_rules() -> list[Rule]:
    """The rules over the columns of :func:`text_metrics`."""
    words, chars = F.col("n_words"), F.col("word_chars")

    def share(part: str, whole: Column) -> Column:
        return F.col(part) / F.greatest(whole, F.lit(1))

    return [
        Rule("symbols", share("n_symbols", words) < 0.05, share("n_symbols", words) > 0.2),
        Rule("letters", share("n_letters", chars) > 0.9, share("n_letters", chars) < 0.8),
        Rule("capitals", share("n_upper", F.col("n_letters")) < 0.15, share("n_upper", F.col("n_letters")) > 0.4),
        Rule("marks", share("n_marks", words) < 0.05, share("n_marks", words) > 0.2),
        Rule("word_length", chars.between(words * 3, words * 9), (chars < words * 2) | (chars > words * 14)),
        Rule("repeated_lines", share("n_dup_lines", F.col("n_lines")) < 0.1, share("n_dup_lines", F.col("n_lines")) > 0.3),
        Rule("repeated_windows", share("n_repeat_words", words) < 0.1, share("n_repeat_words", words) > 0.3),
        Rule("vocabulary", share("n_distinct", words) > 0.3, share("n_distinct", words) < 0.1),
    ]


@dataclass(frozen=True)
class VoteModel:
    """``prior`` of good, and for each rule the log-odds for good of its votes -1, 0 and 1."""

    prior: float
    log_odds: tuple[dict[int, float], ...]
    accuracies: tuple[dict[int, dict[int, float]], ...]

    def posterior(self, votes: list[Column]) -> Column:
        odds = F.lit(math.log(self.prior / (1 - self.prior)))
        for vote, table in zip(votes, self.log_odds, strict=True):
            odds = odds + F.when(vote == 1, table[1]).when(vote == -1, table[-1]).otherwise(table[0])
        return 1 / (1 + F.exp(-odds))


def estimate(patterns: list[tuple[tuple[int, ...], int]], n_rules: int, rounds: int = 100) -> VoteModel:
    """Expectation-maximisation over (votes, number of documents).

    The start is the majority of the votes that are not abstentions, a bad vote weighing as much
    as all good ones but one, since most rules have nothing against most documents. Counts are
    smoothed by one document per vote, so no vote is ever impossible and an empty corpus gives
    indifferent rules.
    """
    values = (-1, 0, 1)
    good = {}
    for votes, _ in patterns:
        against, for_it = votes.count(-1), votes.count(1)
        good[votes] = 0.9 if against == 0 else 0.5 if against == 1 and for_it == n_rules - 1 else 0.1

    prior, chance = 0.5, [{y: dict.fromkeys(values, 1 / 3) for y in (0, 1)} for _ in range(n_rules)]
    for _ in range(rounds):
        mass = {1: 1.0, 0: 1.0}
        seen = [{y: dict.fromkeys(values, 1.0) for y in (0, 1)} for _ in range(n_rules)]
        for votes, n in patterns:
            for y, weight in ((1, good[votes] * n), (0, (1 - good[votes]) * n)):
                mass[y] += weight
                for j, vote in enumerate(votes):
                    seen[j][y][vote] += weight
        prior = min(max(mass[1] / (mass[0] + mass[1]), 0.01), 0.99)
        chance = [{y: {v: x / sum(by[y].values()) for v, x in by[y].items()} for y in (0, 1)} for by in seen]
        for votes, _ in patterns:
            odds = math.log(prior / (1 - prior)) + sum(math.log(chance[j][1][v] / chance[j][0][v]) for j, v in enumerate(votes))
            good[votes] = 1 / (1 + math.exp(-max(min(odds, 700.0), -700.0)))
    return VoteModel(prior, tuple({v: math.log(by[1][v] / by[0][v]) for v in values} for by in chance), tuple(chance))


def judge(docs: DataFrame, rules: list[Rule] | None = None) -> DataFrame:
    """Metrics of every row with ``base_failed``, ``quality`` (the posterior) and ``kept``."""
    rules = rules or production_rules()
    metrics = text_metrics(docs)
    repeated = 100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words")
    voted = materialise(
        metrics.select(
            "*",
            ((F.col("n_words") < LEAST_WORDS) | repeated).alias("base_failed"),
            *(rule.vote().alias(f"vote_{rule.name}") for rule in rules),
        ),
        "votes",
    )
    names = [f"vote_{rule.name}" for rule in rules]
    # Texts without words say nothing about the rules.
    counts = voted.where("n_words > 0").groupBy(*names).agg(F.count("*").alias("n")).collect()
    model = estimate([(tuple(row[name] for name in names), row["n"]) for row in counts], len(rules))
    quality = model.posterior([F.col(name) for name in names])
    return voted.withColumn("quality", quality).withColumn("kept", ~F.col("base_failed") & (F.col("quality") >= 0.5))


def digest(docs: DataFrame) -> DataFrame:
    """The contract's columns of every row."""
    return judge(docs).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    )
