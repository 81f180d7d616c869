"""Quality rules: word statistics and learned decision lists, in SQL functions.

:func:`measured` takes the statistics of whole texts with array functions inside one
row; nothing is exploded or shuffled.  :func:`learn` grows a decision list by
sequential covering: each rule is a conjunction of threshold conditions grown
greedily on one part of the labelled rows (information gain over counts that
Spark aggregates per statistic and bin), pruned on the other part, and kept
while it is precise; rows it covers are set aside for the next rule.  A list is
emitted as one ordered ``CASE WHEN`` expression.  Only the count tables
(statistics x bins) reach the driver.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskweave.llm.common import hash_order, temp_name, written

WORD = r"[^\x20\x09-\x0D]+"
SYMBOLS = "#*$%&|<>"
_UNCOUNTED = r"[^#*$%&|<>!?0-9.,;:\p{Lu}]+"
MIN_WORDS = 50
REPEAT_PERCENT = 50
BINS = 32
MAX_RULES = 12
MAX_CONDITIONS = 3
MIN_PRECISION = 0.9
MIN_COVER = 5
BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
FEATURES = ("n_words", "mean_word", "symbol_share", "dup_line_share", "repeat_share", "upper_share", "mark_share",
            "digit_share", "distinct_share", "end_share")


def measured(docs: DataFrame, text_col: str, id_col: str = "doc_id") -> DataFrame:
    """doc_id, the base statistics (long) and FEATURES (double) of every row.

    Words are ``[^\\x20\\x09-\\x0D]+``; a null text has none.  Repeated words are
    those inside a 3-word window that occurs at least twice in the text; equal
    windows are found by sorting the windows' 64-bit hashes with their position.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    lines = F.filter(F.split(text, "\n", -1), lambda s: s.rlike(WORD))
    # the few characters that are counted, taken out of the text in one pass
    step = docs.select(F.col(id_col).alias("doc_id"), F.regexp_extract_all(text, F.lit(WORD), F.lit(0)).alias("w"),
                       lines.alias("lines"), F.regexp_replace(text, _UNCOUNTED, "").alias("k"))
    among = lambda chars: F.length("k") - F.length(F.translate("k", chars, ""))
    step = step.select(
        "doc_id", F.size("w").cast("long").alias("n_words"), F.length(F.array_join("w", "")).cast("long").alias("word_chars"),
        among(SYMBOLS).cast("long").alias("n_symbols"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.size(F.array_distinct("w")).alias("n_distinct"),
        F.length(F.regexp_replace("k", r"[^\p{Lu}]+", "")).alias("n_upper"),
        among("!?").alias("n_marks"), among("0123456789").alias("n_digits"), among(".,;:").alias("n_ends"),
        F.when(F.size("w") >= 3, F.transform(
            F.sequence(F.lit(0), F.size("w") - 3), lambda i: F.xxhash64(F.get("w", i), F.get("w", i + 1), F.get("w", i + 2))))
        .otherwise(F.array().cast("array<bigint>")).alias("h"))
    # position and hash of every window, ordered by hash, of the texts that repeat one
    step = step.withColumn("s", F.when(F.size(F.array_distinct("h")) < F.size("h"), F.sort_array(F.transform(
        "h", lambda h, p: F.struct(h.alias("h"), p.alias("p"))))).otherwise(F.array().cast("array<struct<h:bigint,p:int>>")))
    same = lambda i, j: F.coalesce(F.get("s", i)["h"] == F.get("s", j)["h"], F.lit(False))
    step = step.withColumn("r", F.sort_array(F.transform(
        F.filter(F.col("s"), lambda x, i: same(i, i - 1) | same(i, i + 1)), lambda x: x["p"])))
    covered = F.aggregate(F.col("r"), F.struct(F.lit(-3).alias("last"), F.lit(0).cast("long").alias("n")), lambda a, p: F.struct(
        p.alias("last"), (a["n"] + F.least(F.lit(3), p - a["last"])).alias("n")), lambda a: a["n"])
    step = step.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", covered.alias("n_repeat_words"),
                       "n_distinct", "n_upper", "n_marks", "n_digits", "n_ends")
    per = lambda a, b: F.col(a).cast("double") / F.greatest(F.col(b), F.lit(1)).cast("double")
    return step.select(
        "doc_id", *BASE, per("word_chars", "n_words").alias("mean_word"), per("n_symbols", "word_chars").alias("symbol_share"),
        per("n_dup_lines", "n_words").alias("dup_line_share"), per("n_repeat_words", "n_words").alias("repeat_share"),
        per("n_upper", "word_chars").alias("upper_share"), per("n_marks", "n_words").alias("mark_share"),
        per("n_digits", "word_chars").alias("digit_share"), per("n_distinct", "n_words").alias("distinct_share"),
        per("n_ends", "n_words").alias("end_share"))


# --- Decision lists --------------------------------------------------------------

@dataclass(frozen=True)
class Condition:
    """``feature >= threshold`` or ``feature < threshold``."""

    feature: str
    at_least: bool
    threshold: float

    def column(self) -> Column:
        c = F.col(self.feature).cast("double")
        return c >= self.threshold if self.at_least else c < self.threshold

    def __str__(self) -> str:
        return f"{self.feature} {'>=' if self.at_least else '<'} {self.threshold!r}"


@dataclass(frozen=True)
class Rule:
    conditions: tuple[Condition, ...]
    label: int
    covered: int
    precision: float

    def column(self) -> Column:
        out = F.lit(True)
        for c in self.conditions:
            out = out & c.column()
        return out

    def __str__(self) -> str:
        return " and ".join(map(str, self.conditions)) + f" -> {self.label} ({self.covered} rows, {self.precision:.3f})"


def decision_column(rules: list[Rule], default: int) -> Column:
    """The list as an ordered conditional: the first rule that holds decides."""
    out = F.lit(default)
    for rule in reversed(rules):
        out = F.when(rule.column(), F.lit(rule.label)).otherwise(out)
    return out


def _cuts(rows: DataFrame, features: tuple[str, ...], bins: int) -> dict[str, list[float]]:
    """Distinct inner quantiles of every feature and the middles between them."""
    shares = F.array(*[F.lit((i + 1) / bins) for i in range(bins - 1)])
    got = rows.agg(*[F.percentile_approx(F.col(f).cast("double"), shares, 2000).alias(f) for f in features]).first()
    out = {}
    for f in features:
        own = sorted(set(got[f] or []))
        out[f] = sorted({*own, *((a + b) / 2 for a, b in zip(own, own[1:]))})
    return out


def _counts(rows: DataFrame, cuts: dict[str, list[float]], target: int) -> dict[tuple[str, int], tuple[int, int]]:
    """(feature, bin) -> (rows of the target label, others); one pass, partial
    aggregation, at most features x bins groups."""
    binned = F.array(*[F.struct(F.lit(f).alias("f"), sum(
        ((F.col(f).cast("double") >= c).cast("int") for c in cs), F.lit(0)).alias("b")) for f, cs in cuts.items()])
    got = (rows.select((F.col("label") == target).cast("long").alias("y"), F.explode(binned).alias("x"))
           .groupBy("x.f", "x.b").agg(F.sum("y").alias("p"), F.sum(1 - F.col("y")).alias("n")).collect())
    return {(r["f"], r["b"]): (r["p"], r["n"]) for r in got}


def _gain(p: int, n: int, p0: int, n0: int) -> float:
    """Information gain of a refinement that covers (p, n) of (p0, n0)."""
    if p == 0:
        return 0.0
    return p * (math.log2(p / (p + n)) - math.log2(p0 / (p0 + n0)))


def _best(counts: dict, cuts: dict[str, list[float]]) -> tuple[float, Condition | None, int, int]:
    some = next(iter(cuts))
    p0 = sum(p for (f, _), (p, _) in counts.items() if f == some)
    n0 = sum(n for (f, _), (_, n) in counts.items() if f == some)
    best: tuple[float, Condition | None, int, int] = (1e-9, None, p0, n0)
    if not p0:
        return best
    for f, cs in cuts.items():
        p = n = 0
        for b, cut in enumerate(cs):  # rows below the cut
            dp, dn = counts.get((f, b), (0, 0))
            p, n = p + dp, n + dn
            for at_least, cp, cn in ((False, p, n), (True, p0 - p, n0 - n)):
                gain = _gain(cp, cn, p0, n0)
                if gain > best[0] and cp >= MIN_COVER:
                    best = (gain, Condition(f, at_least, cut), cp, cn)
    return best


def _grow(rows: DataFrame, cuts: dict, target: int, conditions: int) -> list[Condition]:
    out: list[Condition] = []
    while len(out) < conditions:
        gain, found, p, n = _best(_counts(rows, cuts, target), cuts)
        if found is None or found in out:
            break
        out.append(found)
        rows = rows.where(found.column())
        if n == 0:
            break
    return out


def _tried(rows: DataFrame, conditions: list[Condition], target: int) -> list[tuple[int, int]]:
    """(target rows, other rows) that each prefix of ``conditions`` covers."""
    aggs, held = [], F.lit(True)
    for k, c in enumerate(conditions):
        held = held & c.column()
        for name, hit in ((f"p{k}", F.col("label") == target), (f"n{k}", F.col("label") != target)):
            aggs.append(F.sum((held & hit).cast("long")).alias(name))
    got = rows.agg(*aggs).first()
    return [(got[f"p{k}"] or 0, got[f"n{k}"] or 0) for k in range(len(conditions))]


def learn(rows: DataFrame, *, target: int = 0, features: tuple[str, ...] = FEATURES, bins: int = BINS,
          max_rules: int = MAX_RULES, max_conditions: int = MAX_CONDITIONS,
          min_precision: float = MIN_PRECISION) -> tuple[list[Rule], int]:
    """Decision list for ``label == target`` from ``rows(doc_id, label, features)``,
    all of them; the other label is the default.  Two thirds of the rows (by id
    hash) grow rules and one third prunes: the prefix of a rule's conditions with
    the best (p - n) / (p + n) there is kept, the shorter one on a tie.  Without
    rows of the target label the list is empty.
    """
    part = temp_name("part")
    rows = written(rows.select("doc_id", "label", *features)
                   .withColumn(part, F.pmod(F.coalesce(hash_order("doc_id", 4), F.lit(0)), F.lit(3))), "rules-rows")
    cuts = {f: c for f, c in _cuts(rows, features, bins).items() if c}
    rules: list[Rule] = []
    left = rows
    while cuts and len(rules) < max_rules:
        grown = _grow(left.where(F.col(part) > 0), cuts, target, max_conditions)
        if not grown:
            break
        worth = [((p - n) / (p + n) if p + n else -1.0) for p, n in _tried(left.where(F.col(part) == 0), grown, target)]
        pruned = grown[:worth.index(max(worth)) + 1] if max(worth) > -1.0 else grown
        p, n = _tried(left, pruned, target)[-1]
        if p < MIN_COVER or p < min_precision * (p + n):
            break
        rules.append(Rule(tuple(pruned), target, p + n, p / (p + n)))
        left = left.where(~rules[-1].column())
    return rules, 1 - target


def apply_rules(stats: DataFrame, rules: list[Rule], default: int, *, min_words: int = MIN_WORDS,
                repeat_percent: int = REPEAT_PERCENT) -> DataFrame:
    """doc_id, the base statistics, base_failed and kept."""
    failed = (F.col("n_words") < min_words) | (100 * F.col("n_repeat_words") > repeat_percent * F.col("n_words"))
    return stats.select("doc_id", *BASE, failed.alias("base_failed"),
                        (~failed & (decision_column(rules, default) == 1)).alias("kept"))


def quality_rules(docs: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text_col: str = "text",
                  label_col: str = "quality") -> DataFrame:
    """Measure every text, learn the list on all labelled rows, apply it to all.

    Null and empty texts have no words and fail the base rule; repeated rows are
    returned as often as they come (a repeated label counts once per id, the
    larger value); other columns are ignored; an empty table gives an empty
    result, and without labels only the base rule decides.
    """
    stats = written(measured(docs, text_col, id_col), "rules-statistics")
    known = (labels.select(F.col(id_col).alias("doc_id"), F.col(label_col).cast("int").alias("label"))
             .where("label in (0, 1)").groupBy("doc_id").agg(F.max("label").alias("label")))
    rules, default = learn(stats.join(known, "doc_id"))
    return apply_rules(stats, rules, default)
