"""Quality rules by weak supervision: rules vote or abstain, EM estimates what their votes are worth.

Each rule looks at one measure of a text and votes good or poor, or abstains
between two bounds. How often a rule votes each way on good and on poor texts
is unknown; expectation-maximisation estimates it together with the share of
poor texts. The posterior chance of a good text then decides, in place of
demanding that every rule passes.

The measures are DataFrame expressions on the whole text. Texts enter the
estimate as counts of equal vote patterns, of which there are at most 3 to the
power of the number of rules, whatever the input.

Defined cases: null and empty texts have no words and fail the base rules; with
no row at all the estimate is the prior; repeated rows count as rows; an id may
be null.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.tables import written

WINDOW = 5
WHITE = r"[\x20\x09-\x0D]+"
#: Rounds of EM at most, and the change of all estimates below which it ends.
ROUNDS, SETTLED = 25, 1e-4
#: At most this share of good texts gets a poor vote from a rule: its bound is set for that. Without it
#: the estimate could take a fault that only one rule sees for a kind of good text.
FALSE_ALARMS = 0.005
#: Weight in texts of what is assumed of a rule before any text is seen.
PRIOR_WEIGHT = 20.0


@dataclass(frozen=True)
class Rule:
    """A measure, and bounds: good up to one, poor from the other, abstaining between."""

    name: str
    measure: Column
    good: float
    poor: float

    def vote(self) -> Column:
        """1 poor, 2 good, 0 abstains."""
        down = self.good > self.poor
        good = self.measure >= self.good if down else self.measure <= self.good
        poor = self.measure <= self.poor if down else self.measure >= self.poor
        return F.when(poor, 1).when(good, 2).otherwise(0).cast("byte")


def _share(part: str, whole: str) -> Column:
    return F.col(part) / F.greatest(F.col(whole), F.lit(1))


def rules() -> list[Rule]:
    return [
        Rule("length", F.col("n_words").cast("double"), 30, 9),
        Rule("symbols", _share("n_symbols", "n_words"), 0.05, 0.3),
        Rule("repetition", _share("n_repeat_words", "n_words"), 0.05, 0.201),
        Rule("lines", _share("n_dup_lines", "n_lines"), 0.05, 0.3),
        Rule("capitals", _share("n_capitals", "word_chars"), 0.2, 0.5),
        Rule("exclamations", _share("n_exclamations", "n_words"), 0.05, 0.3),
        Rule("word length", F.abs(_share("word_chars", "n_words") - 6.0), 3.5, 7.0),
    ]


def _repeated(hashes: Column, size: int) -> Column:
    """Words covered by windows of ``size`` words whose hash is found twice or more."""

    def covered(sorted_: Column) -> Column:
        again = F.filter(
            sorted_,
            lambda e, k: (F.get(sorted_, k - 1)["hash"] == e["hash"]) | F.coalesce(F.get(sorted_, k + 1)["hash"] == e["hash"], F.lit(False)),
        )
        places = F.sort_array(F.transform(again, lambda e: e["at"]))
        start = F.struct(F.lit(0).alias("end"), F.lit(0).cast("long").alias("n"))
        return F.aggregate(
            places,
            start,
            lambda s, at: F.struct((at + size).alias("end"), (s["n"] + (at + size - F.greatest(at, s["end"]))).alias("n")),
            lambda s: s["n"],
        )

    ordered = F.sort_array(F.transform(hashes, lambda h, k: F.struct(h.alias("hash"), k.alias("at"))))
    # The one-element array has the sorted windows computed once, not once for each window.
    some = F.element_at(F.transform(F.array(ordered), covered), 1)
    return F.when(F.size(F.array_distinct(hashes)) == F.size(hashes), F.lit(0).cast("long")).otherwise(some)


def measures(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """The measures of every whole text: id, n_words, word_chars, n_symbols, n_lines, n_dup_lines, ..."""
    text = F.col("text")
    plain = docs.select(F.col(id_column).alias("id"), F.coalesce(F.col(text_column), F.lit("")).alias("text"))
    split = plain.select(
        "id",
        "text",
        F.filter(F.split(text, WHITE), lambda w: w != "").alias("words"),
        F.filter(F.split(text, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]")).alias("lines"),
    )
    words = F.col("words")
    window = lambda i: F.xxhash64(*[F.get(words, i + k) for k in range(WINDOW)])
    places = F.when(F.size(words) >= WINDOW, F.sequence(F.lit(0), F.size(words) - WINDOW)).otherwise(F.array().cast("array<int>"))
    hashed = split.withColumn("windows", F.transform(places, window))
    return hashed.select(
        "id",
        F.size(words).cast("long").alias("n_words"),
        F.char_length(F.array_join(words, "")).cast("long").alias("word_chars"),
        F.regexp_count(text, F.lit(r"[#*$%&|<>]")).cast("long").alias("n_symbols"),
        F.size("lines").cast("long").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        _repeated(F.col("windows"), WINDOW).alias("n_repeat_words"),
        F.regexp_count(text, F.lit("[A-Z]")).cast("long").alias("n_capitals"),
        F.regexp_count(text, F.lit("!")).cast("long").alias("n_exclamations"),
    )


@dataclass(frozen=True)
class Estimate:
    """Share of poor texts; for each rule the chances of (abstaining, poor, good) on poor and on good texts."""

    poor: float
    votes: list[tuple[tuple[float, float, float], tuple[float, float, float]]]

    def good_chance(self, vote: Column) -> Column:
        """Posterior chance that a text with these votes (an array column) is good."""
        odds = F.lit(math.log((1 - self.poor) / self.poor))
        for k, (on_poor, on_good) in enumerate(self.votes):
            # Of the votes cast; abstaining says nothing.
            weight = [math.log(g / sum(on_good[1:])) - math.log(p / sum(on_poor[1:])) for g, p in zip(on_good, on_poor, strict=True)]
            odds = odds + F.when(F.get(vote, F.lit(k)) == 1, weight[1]).when(F.get(vote, F.lit(k)) == 2, weight[2]).otherwise(0.0)
        return 1 / (1 + F.exp(-F.greatest(F.least(odds, F.lit(40.0)), F.lit(-40.0))))


def _prior(n: int) -> Estimate:
    """A vote for poor is rare on good texts; on poor texts one rule in a few sees the fault."""
    return Estimate(0.1, [((0.05, 0.25, 0.7), (0.05, 0.002, 0.948))] * n)


def estimate(patterns: DataFrame, n_rules: int) -> Estimate:
    """EM on (votes, n): counts of vote patterns. Each round is one aggregation of the patterns."""
    now = _prior(n_rules)
    for _ in range(ROUNDS):
        good = now.good_chance(F.col("votes"))
        rows = patterns.select("votes", (F.col("n") * good).alias("good"), (F.col("n") * (1 - good)).alias("poor"))
        sums = [F.sum("poor"), F.sum("good")]
        for k in range(n_rules):
            for of in ("poor", "good"):
                sums += [F.sum(F.when(F.get("votes", F.lit(k)) == v, F.col(of)).otherwise(0.0)) for v in range(3)]
        found = [x or 0.0 for x in rows.agg(*sums).first()]
        prior = _prior(n_rules)
        chances = []
        for k in range(n_rules):
            pair = []
            for j in range(2):
                seen = found[2 + 6 * k + 3 * j : 5 + 6 * k + 3 * j]
                share = [(s + PRIOR_WEIGHT * p) / (sum(seen) + PRIOR_WEIGHT) for s, p in zip(seen, prior.votes[k][j], strict=True)]
                if j == 1 and share[1] > FALSE_ALARMS:
                    share = [x * (1 - FALSE_ALARMS) / (1 - share[1]) for x in share]
                    share[1] = FALSE_ALARMS
                pair.append(tuple(share))
            chances.append((pair[0], pair[1]))
        poor = (found[0] + PRIOR_WEIGHT * prior.poor) / (found[0] + found[1] + PRIOR_WEIGHT)
        after = Estimate(poor, chances)
        moved = max(abs(a - b) for x, y in zip(after.votes, now.votes, strict=True) for p, q in zip(x, y, strict=True) for a, b in zip(p, q, strict=True))
        now, moved = after, max(moved, abs(after.poor - now.poor))
        if moved < SETTLED:
            break
    return now


def judged(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row for each row of ``docs``: id, all measures, votes, good_chance, base_failed, kept."""
    kinds = rules()
    votes = F.array(*[r.vote() for r in kinds])
    rows = written(measures(docs, id_column, text_column).withColumn("votes", votes))
    patterns = written(rows.groupBy("votes").agg(F.count(F.lit(1)).alias("n")))
    found = estimate(patterns, len(kinds))
    base = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    return (
        rows.withColumn("good_chance", found.good_chance(F.col("votes")))
        .withColumn("base_failed", base)
        .withColumn("kept", ~F.col("base_failed") & (F.col("good_chance") >= 0.5))
        .withColumnRenamed("id", id_column)
    )
