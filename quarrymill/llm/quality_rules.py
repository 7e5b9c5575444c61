"""Rules that vote on a document's quality, weighed by accuracies that expectation-maximisation estimates."""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarrymill.llm.common import packed, unpacked
from quarrymill.operators.lineage import Scratch

SPACE = r"[\x20\x09-\x0D]"
WINDOW = 8
SIGNALS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_upper", "n_bangs", "n_stops", "n_adjacent")


@dataclass(frozen=True)
class Rule:
    """Votes 1 (good) where the SQL ``good`` over the signals holds and -1 (bad) where ``bad`` does, else abstains.

    ``good_votes`` and ``bad_votes`` are what share of good and of bad documents is believed to get such a vote before any is seen.
    """

    name: str
    good: str | None = None
    good_votes: tuple[float, float] = (0.9, 0.5)
    bad: str | None = None
    bad_votes: tuple[float, float] = (0.03, 0.3)


#: Rules overlap and disagree: several look at the same fault from different sides, others vouch for what they know and say nothing of
#: the rest, and some (repeats, line_copies, word_length, length) are doubted from the start. Only the estimates tell which to follow.
RULES = (
    Rule("symbols", bad="100 * n_symbols > 20 * n_words"),
    Rule("symbol_share", bad="100 * n_symbols > 4 * word_chars"),
    Rule("capitals", bad="100 * n_upper > 30 * word_chars"),
    Rule("bangs", bad="100 * n_bangs > 20 * n_words"),
    Rule("stutter", bad="100 * n_adjacent > 20 * n_words"),
    Rule("repeats", bad="n_words >= 60 and 100 * n_repeat_words > 25 * n_words", bad_votes=(0.1, 0.3)),
    Rule("line_copies", bad="n_lines >= 4 and 100 * n_dup_lines > 30 * n_lines", bad_votes=(0.1, 0.3)),
    Rule("word_length", bad="word_chars < 3 * n_words or word_chars > 10 * n_words", bad_votes=(0.1, 0.3)),
    Rule("plain", "100 * n_symbols <= 5 * n_words and 100 * n_upper <= 10 * word_chars and 100 * n_bangs <= 2 * n_words"),
    Rule("varied", "100 * n_adjacent <= 5 * n_words and 100 * n_repeat_words <= 10 * n_words"),
    Rule("sentences", "100 * n_stops >= 4 * n_words and 100 * n_stops <= 25 * n_words", bad="n_words >= 60 and (100 * n_stops < 2 * n_words or 100 * n_stops > 60 * n_words)", bad_votes=(0.05, 0.2)),
    Rule("length", "n_words >= 100", (0.6, 0.5), "n_words < 50", (0.2, 0.3)),
)
#: The share of good documents before any is seen, and its bounds; beliefs count as so many documents of each kind.
PRIOR, LEAST_PRIOR, MOST_PRIOR, BELIEVED = 0.8, 0.5, 0.99, 10.0
ROUNDS = 40


@dataclass(frozen=True)
class RuleModel:
    """The share of good documents, and for each rule the shares of good and of bad documents that get its vote for and against."""

    prior: float
    good_votes: tuple[tuple[float, float], ...]
    bad_votes: tuple[tuple[float, float], ...]

    def weights(self) -> list[tuple[float, float]]:
        """For each rule what its votes for and against add to the log odds that a document is good; an abstention adds nothing."""
        return [tuple(math.log(g / b) for g, b in both) for both in zip(self.good_votes, self.bad_votes, strict=True)]

    def accuracy(self) -> list[tuple[float, float]]:
        """For each rule the chances that its votes for and against are right, were good and bad documents equally many."""
        return [(g[0] / (g[0] + g[1]), b[1] / (b[0] + b[1])) for g, b in zip(self.good_votes, self.bad_votes, strict=True)]

    def odds(self, votes: tuple[int, ...]) -> float:
        found = math.log(self.prior / (1 - self.prior))
        for v, (ahead, against) in zip(votes, self.weights(), strict=True):
            found += ahead if v > 0 else against if v < 0 else 0.0
        return found


def with_signals(docs: DataFrame) -> DataFrame:
    """Adds SIGNALS to rows that have a column ``text``; each is a long, and 0 for null texts.

    Windows of eight words are compared by 64-bit hashes inside one text, sorted with their places, so that the work grows as
    n log n with the text's length.
    """
    text = F.coalesce("text", F.lit(""))
    df = docs.withColumn("words", F.filter(F.split(text, SPACE + "+"), lambda w: w != "")).withColumn("lines", F.filter(F.split(text, "\n"), lambda x: F.btrim(x, F.lit(" \t\n\x0b\x0c\r")) != ""))
    n = F.size("words")
    df = df.withColumn("hashes", F.when(n >= WINDOW, F.transform(F.sequence(F.lit(1), n - WINDOW + 1), lambda i: F.xxhash64(F.slice("words", i, WINDOW)))).otherwise(F.array().cast("array<bigint>")))
    repeated = F.size(F.array_distinct("hashes")) < F.size("hashes")
    df = df.withColumn("placed", F.when(repeated, F.sort_array(F.transform("hashes", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))).otherwise(F.array().cast("array<struct<h:bigint,i:int>>")))
    near = lambda i: F.coalesce(F.get("placed", i).getField("h"), F.lit(None).cast("bigint"))
    twice = F.filter("placed", lambda x, i: F.coalesce(x["h"] == near(i - 1), F.lit(False)) | F.coalesce(x["h"] == near(i + 1), F.lit(False)))
    df = df.withColumn("places", F.sort_array(F.transform(twice, lambda x: x["i"])))
    covered = F.aggregate(F.transform("places", lambda p, i: F.least(F.lit(WINDOW), F.coalesce(F.get("places", i + 1) - p, F.lit(WINDOW)))), F.lit(0).cast("bigint"), lambda a, x: a + x)
    signals = {
        "n_words": n,
        "word_chars": F.length(F.array_join("words", "")),
        "n_symbols": F.regexp_count(text, F.lit("[#*$%&|<>]")),
        "n_dup_lines": F.size("lines") - F.size(F.array_distinct("lines")),
        "n_repeat_words": covered,
        "n_lines": F.size("lines"),
        "n_upper": F.regexp_count(text, F.lit("[A-Z]")),
        "n_bangs": F.regexp_count(text, F.lit("[!]")),
        "n_stops": F.regexp_count(text, F.lit("[.?!]")),
        "n_adjacent": F.size(F.filter("words", lambda w, i: F.coalesce(w == F.get("words", i - 1), F.lit(False)))),
    }
    return df.withColumns({k: v.cast("bigint") for k, v in signals.items()}).drop("words", "lines", "hashes", "placed", "places")


def votes() -> list[Column]:
    against = lambda r: F.when(F.expr(r.bad), -1) if r.bad else F.when(F.lit(False), 0)
    return [(F.when(F.expr(r.good), 1).otherwise(against(r).otherwise(0)) if r.good else against(r).otherwise(0)).cast("tinyint") for r in RULES]


def base_failed() -> Column:
    return F.expr("n_words < 20 or 100 * n_repeat_words > 30 * n_words")


def estimated(patterns: list[tuple[tuple[int, ...], int]], rounds: int = ROUNDS) -> RuleModel:
    """Expectation-maximisation over vote patterns and their numbers of documents, from the beliefs in RULES.

    Documents are good with the prior chance; given whether one is, rules vote independently. Each round takes the posterior of each
    pattern, then the prior and the shares of votes among good and bad documents anew.
    """
    believed = [(r.good_votes, r.bad_votes) for r in RULES]
    model = RuleModel(PRIOR, tuple(g for g, _ in believed), tuple(b for _, b in believed))
    for _ in range(rounds):
        weighed = [(v, n, 1 / (1 + math.exp(-model.odds(v)))) for v, n in patterns]
        good, bad = sum(n * p for _, n, p in weighed), sum(n * (1 - p) for _, n, p in weighed)
        share = lambda j, vote, start: (
            (BELIEVED * start[0] + sum(n * p for v, n, p in weighed if v[j] == vote)) / (BELIEVED + good),
            (BELIEVED * start[1] + sum(n * (1 - p) for v, n, p in weighed if v[j] == vote)) / (BELIEVED + bad),
        )
        prior = min(MOST_PRIOR, max(LEAST_PRIOR, (BELIEVED * PRIOR + good) / (BELIEVED + good + bad)))
        model = RuleModel(prior, tuple(share(j, 1, g) for j, (g, _) in enumerate(believed)), tuple(share(j, -1, b) for j, (_, b) in enumerate(believed)))
    return model


def fit(signals: DataFrame, rounds: int = ROUNDS) -> RuleModel:
    """The estimates for all rows; what is gathered are the counts of vote patterns, a few thousand rows at most whatever the corpus."""
    names = [f"v{i}" for i in range(len(RULES))]
    counted = signals.select(*[v.alias(n) for v, n in zip(votes(), names, strict=True)]).groupBy(*names).count().collect()
    return estimated(sorted((tuple(r[:-1]), r[-1]) for r in counted), rounds)


def good_chance(model: RuleModel) -> Column:
    """The posterior probability that a document is good, from the signals; the prior without votes."""
    out = F.lit(math.log(model.prior / (1 - model.prior)))
    for vote, (ahead, against) in zip(votes(), model.weights(), strict=True):
        out = out + F.when(vote > 0, ahead).when(vote < 0, against).otherwise(0.0)
    return 1 / (1 + F.exp(-out))


def quality_rules(docs: DataFrame, text_col: str = "text", least: float = 0.5, with_text: bool = True) -> DataFrame:
    """The rows of ``docs`` with SIGNALS, ``base_failed``, ``good_chance`` and ``kept``; without the text if ``with_text`` is false.

    base_failed: fewer than 20 words, or over 30 % of them in windows of eight words that the text has twice. kept: not that, and a
    posterior probability of ``least`` or more. A vote against is outweighed where the estimates find that it says little.
    Texts are measured once: rows and signals are written to the shared folder, from which the votes are counted and the verdicts taken.
    No shuffle but that of the vote patterns' counts.

    Null and empty texts have signals of 0 and fail. Repeated rows and ties get the same verdict each, as it depends on the text
    only; they weigh in the estimate as often as they occur. Input columns of the same names are replaced. An empty table gives
    an empty result.
    """
    rows = packed(docs, text=docs[f"`{text_col}`"])
    columns = docs.columns
    if not with_text and len(columns) > 1:
        rows, columns = rows.withColumn("row", F.col("row").dropFields(text_col)), [c for c in columns if c != text_col]
    measured = Scratch(docs.sparkSession).keep(with_signals(rows).drop("text"))
    chance = good_chance(fit(measured))
    new = {k: F.col(k) for k in SIGNALS} | {"base_failed": base_failed(), "good_chance": chance, "kept": ~base_failed() & (chance >= least)}
    return unpacked(measured, columns, **new)
