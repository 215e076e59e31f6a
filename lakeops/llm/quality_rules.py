"""Quality rules: a learned decision list over text statistics, in DataFrame functions throughout.

``text_statistics`` counts, for every whole text, what the rules look at. ``learn_rules`` covers the
labelled documents one rule at a time: it grows a conjunction of thresholds by FOIL's gain on two
thirds of them, prunes it from the end on the other third, moves each threshold to the middle of the
gap that it stands in, removes what it covers and goes on, until no rule is right more often than
``PRECISION``. All counts come from Spark: each step groups the
labelled rows, whose statistics were cut at quantiles before, by statistic and bin, so the driver
sees (statistics x bins) sums and never rows. The rules become one ordered conditional expression.

Words are runs of anything but blank, tab, line feed, vertical tab, form feed and carriage return.
Null and empty texts have no words, and fail the base rule. Every text is one row of work, whatever
its length; windows are compared within the row by 64-bit hashes. Labels that are null are ignored, a
document with several labels counts once for each, and without any labels the list is empty and
keeps everything that the base rule keeps. Repeated rows each come back.
"""

from __future__ import annotations

from dataclasses import dataclass
from math import log2

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeops.session import materialise

WINDOW = 3
MIN_WORDS = 50
#: Percent of words that may stand in repeated windows.
MAX_REPEATED = 50
BINS = 24
MAX_RULES, MAX_CONDITIONS = 12, 3
#: Share of low-quality documents among those that a rule must cover to be used.
PRECISION = 0.8
MIN_COVERED = 4
BLANKS = " \t\n\x0b\x0c\r"
_BLANK_RUN = "[\\x20\\x09-\\x0D]+"
#: Repeated windows that are looked up in a list; more are found by sorting.
FEW = 32

#: name -> expression over the counts; null where it has no value, in texts without words or lines ("/" may be an error there)
RATIOS = {
    "words": "cast(n_words as double)",
    "word_length": "try_divide(word_chars, n_words)",
    "symbol_share": "try_divide(n_symbols, word_chars)",
    "repeated_lines": "try_divide(n_dup_lines, n_lines)",
    "repeated_words": "try_divide(n_repeat_words, n_words)",
    "capital_share": "try_divide(n_capitals, word_chars)",
    "bang_share": "try_divide(n_bangs, word_chars)",
}


def _covered_words(places: Column) -> Column:
    """Words under the windows at ``places``, which rise: each adds what the one before has not covered."""
    return F.aggregate(
        places, F.struct(F.lit(0).alias("n"), F.lit(-WINDOW).alias("last")),
        lambda s, i: F.struct((s["n"] + F.least(i - s["last"], F.lit(WINDOW))).alias("n"), i.alias("last")),
        lambda s: s["n"])


def _places_among(hashes: Column, repeated: Column) -> Column:
    """Places of the windows whose hash is in a short list."""
    return F.filter(F.transform(hashes, lambda h, i: F.when(F.array_contains(repeated, h), i)), lambda i: i.isNotNull())


def _places_by_sorting(hashes: Column) -> Column:
    """Places of the windows that have an equal neighbour when hashes are sorted with their places."""
    def repeats(ordered: Column) -> Column:
        return F.filter(
            F.transform(ordered, lambda x, j: F.when(
                (F.get(ordered, j - 1)["h"] == x["h"]) | (F.get(ordered, j + 1)["h"] == x["h"]), x["i"])),
            lambda i: i.isNotNull())

    paired = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    # bound to a lambda variable, so that it is sorted once for a row and not once for an element
    return F.sort_array(F.get(F.transform(F.array(paired), lambda x: repeats(x)), F.lit(0)))


def text_statistics(docs: DataFrame) -> DataFrame:
    """doc_id and the counts of every text.

    Arrays that later steps look into are columns of a projection of their own and are used there more
    than once, so that the optimizer keeps them apart and computes them once for a row.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    inner = F.btrim(text, F.lit(BLANKS))
    lines = F.filter(F.split(text, "\n"), lambda line: F.btrim(line, F.lit(BLANKS)) != "")

    def number(pattern: str) -> Column:
        return F.regexp_count(text, F.lit(pattern)).cast("bigint")

    counted = docs.select(
        "doc_id", F.when(inner == "", F.array().cast("array<string>")).otherwise(F.split(inner, _BLANK_RUN)).alias("w"),
        number("[#*$%&|<>]").alias("n_symbols"), number("[A-Z]").alias("n_capitals"), number("!").alias("n_bangs"),
        lines.alias("lines"))
    windows = counted.select(
        "doc_id", "n_symbols", "n_capitals", "n_bangs", F.size("w").cast("bigint").alias("n_words"),
        F.char_length(F.array_join("w", "")).cast("bigint").alias("word_chars"),
        F.size("lines").cast("bigint").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("bigint").alias("n_dup_lines"),
        F.transform(F.slice("w", 1, F.greatest(F.size("w") - (WINDOW - 1), F.lit(0))), lambda first, i: F.xxhash64(
            first, *[F.get(F.col("w"), i + k) for k in range(1, WINDOW)])).alias("hashes"))
    ordered = windows.withColumn("ordered", F.sort_array("hashes"))
    repeated = ordered.withColumn("repeated", F.array_distinct(
        F.filter("ordered", lambda x, j: x == F.get(F.col("ordered"), j - 1))))
    n_repeat = (F.when(F.size("repeated") == 0, 0)
                 .when(F.size("repeated") <= FEW, _covered_words(_places_among(F.col("hashes"), F.col("repeated"))))
                 .otherwise(_covered_words(_places_by_sorting(F.col("hashes")))))
    return repeated.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines",
                           n_repeat.cast("bigint").alias("n_repeat_words"), "n_lines", "n_capitals", "n_bangs")


def base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEATED * F.col("n_words"))


@dataclass(frozen=True)
class Condition:
    statistic: str
    above: bool
    threshold: float

    def column(self) -> Column:
        value = F.expr(RATIOS[self.statistic])
        return F.coalesce(value > self.threshold if self.above else value <= self.threshold, F.lit(False))


Rule = tuple[Condition, ...]


def _holds(rule: Rule) -> Column:
    held = F.lit(True)
    for condition in rule:
        held = held & condition.column()
    return held


def decision(rules: list[Rule]) -> Column:
    """The ordered conditional expression: whether a document is kept."""
    verdict = None
    for rule in rules:
        verdict = (F if verdict is None else verdict).when(_holds(rule), F.lit(False))
    return F.lit(True) if verdict is None else verdict.otherwise(F.lit(True))


def learn_rules(labelled: DataFrame) -> list[Rule]:
    """Rules for low quality from counts and ``quality`` (1 or 0) of labelled documents."""
    rows = materialise(labelled.where(F.col("quality").isin(0, 1)).withColumn(
        "_prune", F.pmod(F.xxhash64("doc_id"), F.lit(3)) == 0), "labelled")
    steps = [i / BINS for i in range(1, BINS)]
    cut = rows.agg(*[F.percentile_approx(F.expr(e), steps, 10_000).alias(n) for n, e in RATIOS.items()]).first()
    cuts = {n: sorted(set(cut[n] or [])) for n in RATIOS}
    rules: list[Rule] = []
    left = rows
    while len(rules) < MAX_RULES:
        rule = _pruned(left.where("_prune"), _grown(left.where("not _prune"), cuts))
        if not rule:
            break
        bad, good = _covered(left, rule)
        if bad < MIN_COVERED or bad < PRECISION * (bad + good):
            break
        rules.append(_centred(left, rule))
        left = left.where(~_holds(rules[-1]))
    return rules


def _covered(rows: DataFrame, rule: Rule) -> tuple[int, int]:
    found = rows.where(_holds(rule)).agg(F.count_if(F.col("quality") == 0).alias("bad"), F.count_if(F.col("quality") == 1).alias("good"))
    return tuple(found.first())


def _grown(rows: DataFrame, cuts: dict[str, list[float]]) -> Rule:
    """Add the condition with the largest gain until no good document is covered."""
    rule: Rule = ()
    bins = F.array(*[
        F.struct(F.lit(n).alias("statistic"),
                 sum((F.when(F.expr(RATIOS[n]) > c, 1).otherwise(0) for c in cuts[n]), F.lit(0)).alias("bin"),
                 F.expr(RATIOS[n]).isNotNull().alias("known"))
        for n in RATIOS])
    while len(rule) < MAX_CONDITIONS:
        sums = (rows.where(_holds(rule)).select("quality", F.explode(bins).alias("b")).where("b.known")
                    .groupBy("b.statistic", "b.bin")
                    .agg(F.count_if(F.col("quality") == 0).alias("bad"), F.count_if(F.col("quality") == 1).alias("good")).collect())
        if rule:
            bad, good = _covered(rows, rule)
        else:
            bad, good = (sum(r[k] for r in sums if r["statistic"] == "words") for k in ("bad", "good"))
        if not bad or not good:
            break
        best, most = None, 0.0
        for name, places in sorted(cuts.items()):
            own = {r["bin"]: (r["bad"], r["good"]) for r in sums if r["statistic"] == name}
            total = [sum(v[k] for v in own.values()) for k in (0, 1)]
            low = [0, 0]
            for i, place in enumerate(places):
                low = [low[k] + own.get(i, (0, 0))[k] for k in (0, 1)]
                for above, (p, n) in ((False, low), (True, [total[0] - low[0], total[1] - low[1]])):
                    if p >= MIN_COVERED:
                        gain = p * (log2(p / (p + n)) - log2(bad / (bad + good)))
                        if gain > most + 1e-9:
                            best, most = Condition(name, above, place), gain
        if best is None or best in rule:
            break
        rule = (*rule, best)
    return rule


def _pruned(rows: DataFrame, rule: Rule) -> Rule:
    """The shortest head of the rule with the best (bad - good) / (bad + good) on other rows."""
    best, value = rule, None
    for length in range(1, len(rule) + 1):
        bad, good = _covered(rows, rule[:length])
        worth = (bad - good) / (bad + good) if bad + good else -1.0
        if value is None or worth > value:
            best, value = rule[:length], worth
    return best


def _centred(rows: DataFrame, rule: Rule) -> Rule:
    """Each threshold halfway between the labelled values that it parts."""
    for i, condition in enumerate(rule):
        value = F.expr(RATIOS[condition.statistic])
        ends = (rows.where(_holds(rule[:i] + rule[i + 1:]))
                    .agg(F.max(F.when(value <= condition.threshold, value)).alias("below"),
                         F.min(F.when(value > condition.threshold, value)).alias("over")).first())
        if ends["below"] is not None and ends["over"] is not None:
            middle = Condition(condition.statistic, condition.above, (ends["below"] + ends["over"]) / 2)
            rule = (*rule[:i], middle, *rule[i + 1:])
    return rule


def apply_rules(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The counts of every document, ``base_failed`` and ``kept``."""
    counted = materialise(text_statistics(docs), "statistics")
    rules = learn_rules(counted.join(labels.select("doc_id", "quality"), "doc_id"))
    return (counted.withColumn("base_failed", base_failed())
                   .withColumn("kept", ~base_failed() & decision(rules)))
