"""Learned decision lists over text statistics, in DataFrame and SQL functions only.

Statistics of every whole text are computed once and written. Rules are learned on the labelled rows by sequential covering: two
thirds of them (by hash) grow a conjunction of thresholds, adding the condition with the largest information gain on
"bad" until it covers hardly any good row or has ``MAX_CONDITIONS``; the other third prunes its last conditions. A rule
that stays precise on the pruning rows is kept and the rows it covers are set aside; else no later rule opens with
the statistic that it opened with. Growing and
pruning see counts per (statistic, threshold) only, aggregated by Spark over all labelled rows; thresholds
are quantiles of them. The list becomes one ordered conditional expression, applied to all rows.

Cases: a null or empty text has no word and fails the base rule; a label row without quality is ignored, and a document with several
labels counts as bad if one says so; without labelled rows, or without both kinds, no rule is learned and the base rule alone decides;
repeated rows are judged each; null ids match no label; other columns are ignored; an empty table gives an empty result.
Windows of three words are compared by 64-bit hashes of their words.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardlens.functions.scale import materialize

BLANKS = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"
MIN_WORDS = 50
MAX_REPEATED_PERCENT = 50
QUANTILES = (0.01, 0.02, 0.05, *(k / 20 for k in range(2, 19)), 0.95, 0.98, 0.99)
MAX_RULES = 8
MAX_CONDITIONS = 3
MIN_PRECISION = 0.9
MIN_COVERED = 5
BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def text_statistics(docs: DataFrame) -> DataFrame:
    """doc_id, the base statistics and a few more, per row of ``docs``."""
    text = F.coalesce(F.col("`text`").cast("string"), F.lit(""))
    spaced = docs.select(
        F.col("`doc_id`").alias("doc_id"), text.alias("t"), F.translate(text, BLANKS, " " * len(BLANKS)).alias("plain")
    )
    split = spaced.select(
        "doc_id", "t", F.array_remove(F.split("plain", " "), "").alias("words"),
        F.length(F.replace("plain", F.lit(" "), F.lit(""))).cast("long").alias("word_chars"),
        F.filter(F.split("t", "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]")).alias("lines"),
    )
    counted = split.select(
        "doc_id",
        "words",
        F.size("words").alias("n"),
        "word_chars",
        (F.length("t") - F.length(F.translate("t", SYMBOLS, ""))).cast("long").alias("n_symbols"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        (F.length("t") - F.length(F.translate("t", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", ""))).cast("long").alias("n_capitals"),
        (F.length("t") - F.length(F.replace("t", F.lit("!"), F.lit("")))).cast("long").alias("n_exclaims"),
        F.size(F.array_distinct("words")).cast("long").alias("n_distinct"),
    )
    numbers = ["n_symbols", "n_dup_lines", "n_capitals", "n_exclaims", "n_distinct"]
    kept = ["doc_id", "n", "word_chars", *numbers]
    at = F.sequence(F.lit(0), F.col("n") - 3)
    windows = counted.select(
        *kept,
        F.when(
            F.col("n") >= 3,
            F.sort_array(
                F.transform(
                    at,
                    lambda i: F.struct(
                        F.xxhash64(
                            F.get("words", i), F.get("words", i + 1), F.get("words", i + 2)
                        ).alias("h"),
                        i.alias("i"),
                    ),
                )
            ),
        ).alias("sorted"),
    )
    same = lambda x, other: F.coalesce(x["h"] == other["h"], F.lit(False))
    repeated = windows.select(
        *kept,
        F.sort_array(
            F.transform(
                F.filter(
                    "sorted",
                    lambda x, i: same(x, F.get("sorted", i - 1)) | same(x, F.get("sorted", i + 1)),
                ),
                lambda x: x["i"],
            )
        ).alias("starts"),
    )
    nothing = F.struct(F.lit(0).alias("covered"), F.lit(0).alias("until"))
    covered = F.aggregate(
        "starts",
        nothing,
        lambda a, i: F.struct(
            (a["covered"] + i + 3 - F.greatest(a["until"], i)).alias("covered"), (i + 3).alias("until")
        ),
        lambda a: a["covered"],
    )
    return repeated.select(
        "doc_id", F.col("n").cast("long").alias("n_words"), "word_chars", *numbers,
        F.coalesce(covered, F.lit(0)).cast("long").alias("n_repeat_words"),
    )


def base_failed() -> Column:
    repeated = 100 * F.col("n_repeat_words") > MAX_REPEATED_PERCENT * F.col("n_words")
    return (F.col("n_words") < MIN_WORDS) | repeated


def features() -> dict[str, Column]:
    """The statistics that rules may use, independent of a text's length but for the first."""
    words = F.greatest(F.col("n_words"), F.lit(1)).cast("double")
    chars = F.greatest(F.col("word_chars"), F.lit(1)).cast("double")
    return {
        "words": F.col("n_words").cast("double"),
        "word_length": F.col("word_chars") / words,
        "symbol_share": F.col("n_symbols") / chars,
        "duplicate_lines": F.col("n_dup_lines") / words,
        "repeated_share": F.col("n_repeat_words") / words,
        "capital_share": F.col("n_capitals") / chars,
        "exclaim_share": F.col("n_exclaims") / words,
        "distinct_share": F.col("n_distinct") / words,
    }


@dataclass(frozen=True)
class Condition:
    """``feature >= threshold`` if ``above``, else ``feature < threshold``; ``rank`` is the threshold's number."""

    feature: str
    threshold: float
    rank: int
    above: bool

    def column(self) -> Column:
        value = features()[self.feature]
        return value >= self.threshold if self.above else value < self.threshold

    def on_bins(self) -> Column:
        return F.col(self.feature) > self.rank if self.above else F.col(self.feature) <= self.rank

    def __str__(self) -> str:
        return f"{self.feature} {'>=' if self.above else '<'} {self.threshold:.6g}"


Rule = tuple[Condition, ...]


def _all(conditions: list[Column]) -> Column:
    out = F.lit(True)
    for c in conditions:
        out = out & c
    return out


def _bins(labelled: DataFrame) -> tuple[DataFrame, dict[str, list[float]]]:
    """Labelled rows with, per feature, how many of its thresholds do not exceed the value."""
    columns = features()
    row = labelled.agg(
        *[F.percentile_approx(c, F.array(*map(F.lit, QUANTILES)), 10_000).alias(f) for f, c in columns.items()],
        *[F.min(F.when(c > 0, c)).alias(f"least_{f}") for f, c in columns.items()],
    ).first()
    # The least positive value tells "some" from "none" where most texts have none.
    thresholds = {f: sorted({*(row[f] or []), *filter(None, [row[f"least_{f}"]])}) for f in columns}

    def rank(f: str, c: Column) -> Column:
        passed = [F.when(c >= t, 1).otherwise(0) for t in thresholds[f]]
        return sum(passed, F.lit(0)).cast("int").alias(f)

    return labelled.select("bad", "grows", *[rank(f, c) for f, c in columns.items()]), thresholds


def _gain(bad: int, good: int, all_bad: int, all_good: int) -> float:
    if not bad:
        return -math.inf
    return bad * (math.log2(bad / (bad + good)) - math.log2(all_bad / (all_bad + all_good)))


def _grow(rows: DataFrame, thresholds: dict[str, list[float]], failed: frozenset[str] = frozenset()) -> Rule:
    """Add the best condition until hardly a good row is covered; one aggregation per condition.

    A rule does not open with a statistic in ``failed``.
    """
    rule: list[Condition] = []
    while len(rule) < MAX_CONDITIONS:
        counts: dict[str, dict[int, tuple[int, int]]] = {f: {} for f in thresholds}
        cell = F.explode(F.array(*[F.struct(F.lit(f).alias("f"), F.col(f).alias("b")) for f in thresholds])).alias("c")
        inside = rows.where(_all([c.on_bins() for c in rule])).select("bad", cell)
        for r in inside.groupBy("c.f", "c.b").agg(
            F.count_if("bad").alias("bad"), F.count_if(~F.col("bad")).alias("good")
        ).collect():
            counts[r["f"]][r["b"]] = (r["bad"], r["good"])
        any_feature = next(iter(counts.values()))
        all_bad, all_good = (sum(v[i] for v in any_feature.values()) for i in (0, 1))
        if not all_bad or not all_good or all_good <= (1 - MIN_PRECISION) / 2 * (all_bad + all_good) and rule:
            break
        best, best_gain = None, 1e-9
        for f in sorted(set(thresholds) - (failed if not rule else set())):
            for k, t in enumerate(thresholds[f]):
                above = [sum(v[i] for b, v in counts[f].items() if b > k) for i in (0, 1)]
                for up, (bad, good) in ((True, above), (False, [all_bad - above[0], all_good - above[1]])):
                    gain = _gain(bad, good, all_bad, all_good)
                    if gain > best_gain:
                        best, best_gain = Condition(f, t, k, up), gain
        if best is None:
            break
        rule.append(best)
    return tuple(rule)


def _prune(rows: DataFrame, rule: Rule) -> tuple[Rule, int, int]:
    """The prefix of the rule that is best on the pruning rows, with the bad and good rows it covers there."""
    prefixes = [rule[: n + 1] for n in range(len(rule))]
    row = rows.agg(
        *[
            F.count_if(_all([c.on_bins() for c in p]) & (F.col("bad") == bad)).alias(f"{'bad' if bad else 'good'}{n}")
            for n, p in enumerate(prefixes) for bad in (True, False)
        ]
    ).first()
    worth = [(row[f"bad{n}"] - row[f"good{n}"]) / max(1, row[f"bad{n}"] + row[f"good{n}"]) for n in range(len(rule))]
    n = max(range(len(rule)), key=lambda n: (worth[n], -n))
    return prefixes[n], row[f"bad{n}"], row[f"good{n}"]


def learn_rules(labelled: DataFrame) -> list[Rule]:
    """Rules for bad texts from rows with the statistics, ``bad`` and ``grows`` (false: for pruning)."""
    binned, thresholds = _bins(labelled)
    rows = materialize(binned, "labelled")
    rules: list[Rule] = []
    failed: frozenset[str] = frozenset()
    while len(rules) < MAX_RULES:
        left = rows.where(~_any(rules))
        grown = _grow(left.where("grows"), thresholds, failed)
        if not grown:
            break
        rule, bad, good = _prune(left.where("not grows"), grown)
        if bad >= MIN_COVERED and bad >= MIN_PRECISION * (bad + good):
            rules.append(rule)
        else:
            failed |= {grown[0].feature}
    return rules


def _any(rules: list[Rule]) -> Column:
    out = F.lit(False)
    for rule in rules:
        out = out | _all([c.on_bins() for c in rule])
    return out


def decision_list(rules: list[Rule]) -> Column:
    """The rules as one ordered conditional expression: true keeps the text."""
    out = None
    for rule in rules:
        holds = _all([c.column() for c in rule])
        out = F.when(holds, False) if out is None else out.when(holds, False)
    return F.lit(True) if out is None else out.otherwise(True)


def quality_rules(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Per document: doc_id, the base statistics, base_failed and kept."""
    stats = materialize(text_statistics(docs), "statistics")
    marks = labels.select(F.col("`doc_id`").alias("doc_id"), (F.col("`quality`") == 0).alias("bad")).where(
        F.col("bad").isNotNull()
    ).groupBy("doc_id").agg(F.bool_or("bad").alias("bad"))
    labelled = stats.join(marks, "doc_id").where(~base_failed()).withColumn(
        "grows", F.pmod(F.xxhash64(F.lit("grow"), "doc_id"), F.lit(3)) > 0
    )
    rules = learn_rules(labelled)
    return stats.select(
        "doc_id", *BASE, base_failed().alias("base_failed"), (~base_failed() & decision_list(rules)).alias("kept")
    )
