"""Mixing sources to target weights by iterative proportional fitting.

Documents fall into cells (source, language, topic) that carry their tokens.
Raking scales the cells' token weights to the target marginal of one dimension
after another, ``BLOCK`` sweeps at a time until no marginal is off by more than
``TOLERANCE`` (or ``MAX_SWEEPS`` are done: targets that no weights meet).  A cell's
documents are sampled with probability min(1, factor * weight / tokens); the one
common factor is set so that the expected sampled tokens are the budget.  A cell
that gives all its tokens and is still short leaves the rest of the budget to the
others, so one rare cell moves the yield by no more than its own tokens.
A document is sampled when a uniform number derived from its id is below its
cell's probability.  Each raking step is a window sum over the cells; documents
are read once to count cells and once to be sampled, and only their partial
sums are shuffled.  :func:`report` tells how near the marginals come.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskweave.llm.common import Rounds, temp_name, written

BLOCK = 2           # sweeps between two looks at the marginals
MAX_SWEEPS = 64
TOLERANCE = 1e-10   # largest relative error of a marginal
BUDGET = 0.5        # expected sampled tokens as a share of all tokens
#: Exponent of each dimension's token share in its default target: 1 keeps the
#: corpus's own share, 0 gives every value the same weight.
SMOOTHING = {"source": 0.7, "lang": 0.7, "topic": 0.9}
NO_VALUE = "(none)"
#: (topic, pattern) in order; the first pattern found in the text decides.
TOPICS = (
    ("legal", r"(?i)licen[sc]ed? under|rights reserved|copyright"),
    ("contact", r"@[A-Za-z0-9-]+\.|\+[0-9]+ \("),
    ("secret", r"(?i)(token|password|secret|api_key|key) ?[=:]"),
    ("web", r"https?://"),
    ("table", r" \| "),
)
OTHER_TOPIC = "prose"
WORD = r"[^\x20\x09-\x0D]+"
DIMENSIONS = ("source", "lang", "topic")


def topic_column(text: Column, topics=TOPICS, other: str = OTHER_TOPIC) -> Column:
    out = F.lit(other)
    for name, pattern in reversed(topics):
        out = F.when(F.coalesce(text.rlike(pattern), F.lit(False)), F.lit(name)).otherwise(out)
    return out


def token_column(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def uniform_column(doc_id: Column, seed: int) -> Column:
    """Uniform in [0, 1) from 52 bits of md5(seed:id); 0 for a row without id."""
    digest = F.md5(F.concat(F.lit(f"{seed}:"), doc_id.cast("string")).cast("binary"))
    return F.coalesce(F.conv(F.substring(digest, 1, 13), 16, 10).cast("double") / float(1 << 52), F.lit(0.0))


def with_goals(cells: DataFrame, targets: dict[str, dict[str, float]] | None, smoothing: dict[str, float]) -> DataFrame:
    """``cells`` with ``goal_<dimension>``, the target share of the cell's value:
    of the values that have tokens the shares sum to 1."""
    out = cells
    for d in DIMENSIONS:
        own = Window.partitionBy(d)
        if targets and d in targets:
            goal = F.lit(0.0)
            for value, weight in targets[d].items():
                goal = F.when(F.col(d) == value, F.lit(float(weight))).otherwise(goal)
        else:
            goal = F.pow(F.sum(F.col("tokens").cast("double")).over(own), F.lit(float(smoothing[d])))
        out = out.withColumns({f"goal_{d}": goal, f"n_{d}": F.count("*").over(own)})
    out = written(out, "mixture-goals")
    sums = out.agg(*[F.sum(F.col(f"goal_{d}") / F.col(f"n_{d}")).alias(d) for d in DIMENSIONS]).first()
    return out.select(*DIMENSIONS, "tokens", *[(F.col(f"goal_{d}") / F.lit(float(sums[d] or 1.0))).alias(f"goal_{d}") for d in DIMENSIONS])


def rake(cells: DataFrame, *, targets: dict[str, dict[str, float]] | None = None, smoothing: dict[str, float] = SMOOTHING,
         tolerance: float = TOLERANCE, max_sweeps: int = MAX_SWEEPS) -> tuple[DataFrame, float]:
    """``cells(source, lang, topic, tokens)`` with ``goal_<dimension>`` and the raked
    ``weight``, and the largest relative error of a marginal.

    ``targets`` gives marginal weights per dimension and value (any scale; a
    value left out gets 0); a dimension without targets uses its own token
    marginal to the power in ``smoothing``.  Weights sum to 1.
    """
    rounds = Rounds(cells.sparkSession, "mixture-cells")
    out = with_goals(cells, targets, smoothing).withColumn("weight", F.col("tokens").cast("double"))
    sweeps = 0
    while True:
        for _ in range(BLOCK):
            for d in DIMENSIONS:
                total = F.sum("weight").over(Window.partitionBy(d))
                out = out.withColumn("weight", F.when(total > 0, F.col("weight") * F.col(f"goal_{d}") / total).otherwise(F.lit(0.0)))
        sweeps += BLOCK
        off = F.lit(0.0)
        for d in DIMENSIONS[:-1]:  # the last one has just been met
            got, goal = F.sum("weight").over(Window.partitionBy(d)), F.col(f"goal_{d}")
            off = F.greatest(off, F.when(goal > 0, F.abs(got / goal - 1.0)).otherwise(F.lit(0.0)))
        out = rounds.write(out.withColumn("off", off))
        error = float(out.agg(F.max("off")).first()[0] or 0.0)
        out = out.drop("off")
        if error <= tolerance or sweeps >= max_sweeps:
            return out, error


def budget_factor(raked: DataFrame, budget: float = BUDGET, budget_tokens: float | None = None) -> float:
    """The factor for which sum(tokens * min(1, factor * weight / tokens)) is the
    budget: cells that reach probability 1 are set aside and the rest is scaled to
    what is left of the budget, until no further cell reaches 1."""
    ratio = F.col("weight") / F.col("tokens")
    live = raked.where("weight > 0")
    every, reachable, weight = raked.agg(F.sum("tokens"), F.sum(F.when(F.col("weight") > 0, F.col("tokens"))), F.sum("weight")).first()
    if not weight:
        return 0.0
    goal = min(float(reachable), float(every) * budget if budget_tokens is None else float(budget_tokens))
    factor, full = goal / weight, 0
    while True:
        whole = ratio * F.lit(factor) >= 1.0
        n, tokens, rest = live.agg(F.count(F.when(whole, 1)), F.sum(F.when(whole, F.col("tokens"))),
                                   F.sum(F.when(~whole, F.col("weight")))).first()
        if n == full or not rest:
            return factor
        full, factor = n, max(factor, (goal - float(tokens or 0)) / rest)


def cell_probabilities(docs: DataFrame, *, budget: float = BUDGET, budget_tokens: float | None = None, **options) -> DataFrame:
    """(source, lang, topic, tokens, goals, prob) from ``docs(source, lang, topic, n_tokens)``."""
    cells = docs.groupBy(*DIMENSIONS).agg(F.sum("n_tokens").alias("tokens")).where("tokens > 0")
    raked, _ = rake(cells, **options)
    factor = budget_factor(raked, budget, budget_tokens)
    prob = F.least(F.lit(1.0), F.col("weight") / F.col("tokens") * F.lit(factor))
    return written(raked.withColumn("prob", prob), "mixture-probabilities")


def report(probabilities: DataFrame) -> DataFrame:
    """Per dimension and value: tokens, target (share aimed at), weighted (share of
    the raked weights), expected_tokens, expected (share of the sampled tokens).
    ``expected`` departs from ``target`` only through cells sampled whole."""
    sampled = F.col("tokens") * F.col("prob")
    total = probabilities.agg(F.sum(sampled)).first()[0] or 1.0
    out = None
    for d in DIMENSIONS:
        part = probabilities.groupBy(F.lit(d).alias("dimension"), F.col(d).alias("value")).agg(
            F.sum("tokens").alias("tokens"), F.max(f"goal_{d}").alias("target"), F.sum("weight").alias("weighted"),
            F.sum(sampled).alias("expected_tokens"), (F.sum(sampled) / F.lit(float(total))).alias("expected"))
        out = part if out is None else out.unionByName(part)
    return out


def described(docs: DataFrame, id_col: str, text_col: str, source_col: str, lang_col: str) -> DataFrame:
    named = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(NO_VALUE))
    return docs.select(F.col(id_col).alias("doc_id"), named(source_col).alias("source"), named(lang_col).alias("lang"),
                       topic_column(F.col(text_col)).alias("topic"), token_column(F.col(text_col)).alias("n_tokens"))


def mix(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
        lang_col: str = "lang", seed: int = 2, **options) -> DataFrame:
    """One row per document: doc_id, source, lang, topic, n_tokens, prob (to nine
    digits; the decision uses all), sampled.  ``budget`` (share of all tokens) or
    ``budget_tokens`` sets the expected sampled tokens.

    A null source or language is the value ``(none)``; a null or empty text has
    no tokens, and a cell without any tokens has probability 0.  Repeated rows
    share their id's uniform number, so all or none are sampled; other columns
    are ignored; an empty table gives an empty result.
    """
    rows = written(described(docs, id_col, text_col, source_col, lang_col), "mixture-documents")
    probs = cell_probabilities(rows, **options).select(*DIMENSIONS, "prob")
    prob = F.coalesce("prob", F.lit(0.0))
    return rows.join(probs, list(DIMENSIONS), "left").select(
        "doc_id", *DIMENSIONS, "n_tokens", F.round(prob, 9).alias("prob"),
        (uniform_column(F.col("doc_id"), seed) < prob).alias("sampled"))


def sample(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
           lang_col: str = "lang", seed: int = 2, **options) -> DataFrame:
    """The sampled rows of ``docs``, with its own columns."""
    own = docs.columns
    rows = described(docs, id_col, text_col, source_col, lang_col)
    probs = cell_probabilities(rows, **options).select(*DIMENSIONS, "prob")
    named = {d: temp_name(d) for d in (*DIMENSIONS, "prob")}
    probs = probs.select(*[F.col(c).alias(n) for c, n in named.items()])
    value = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(NO_VALUE))
    tagged = docs.withColumns({named["source"]: value(source_col), named["lang"]: value(lang_col),
                               named["topic"]: topic_column(F.col(text_col))})
    kept = tagged.join(probs, [named[d] for d in DIMENSIONS]).where(
        uniform_column(F.col(id_col), seed) < F.col(named["prob"]))
    return kept.select(*[F.col(f"`{c}`") for c in own])


def mix_sql(documents: str = "documents", *, seed: int = 2, sweeps: int = 32, budget: float = BUDGET,
            smoothing: dict[str, float] = SMOOTHING) -> str:
    """DuckDB SQL of :func:`mix` over ``documents``: a fixed number of sweeps, and the
    factor read off the cells in order of their ratio."""
    topic = "CASE " + " ".join(f"WHEN regexp_matches(coalesce(text, ''), '{p}') THEN '{n}'" for n, p in TOPICS) + f" ELSE '{OTHER_TOPIC}' END"
    goals = ", ".join(f"pow(sum(tokens) OVER (PARTITION BY {x}), {float(smoothing[x])}) AS goal_{x}, count(*) OVER (PARTITION BY {x}) AS n_{x}"
                      for x in DIMENSIONS)
    shares = ", ".join(f"goal_{x} / (SELECT sum(goal_{x} / n_{x}) FROM g) AS goal_{x}" for x in DIMENSIONS)
    steps = [f"""d AS (SELECT doc_id, coalesce(source, '{NO_VALUE}') AS source, coalesce(lang, '{NO_VALUE}') AS lang, {topic} AS topic,
  CAST(len(regexp_extract_all(coalesce(text, ''), '{WORD}')) AS BIGINT) AS n_tokens FROM {documents})""",
             "c AS (SELECT source, lang, topic, CAST(sum(n_tokens) AS DOUBLE) AS tokens FROM d GROUP BY ALL HAVING sum(n_tokens) > 0)",
             f"g AS (SELECT *, {goals} FROM c)",
             f"k0 AS (SELECT source, lang, topic, tokens, tokens AS weight, {shares} FROM g)"]
    n = 0
    for _ in range(sweeps):
        for x in DIMENSIONS:
            steps.append(f"k{n + 1} AS (SELECT * REPLACE (weight * goal_{x} / sum(weight) OVER (PARTITION BY {x}) AS weight) FROM k{n})")
            n += 1
    order = "ORDER BY weight / tokens DESC, source, lang, topic ROWS BETWEEN"
    steps.append(f"""o AS (SELECT source, lang, topic, weight / tokens AS ratio,
  {float(budget)} * (SELECT sum(tokens) FROM c) - coalesce(sum(tokens) OVER ({order} UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS remaining,
  sum(weight) OVER ({order} CURRENT ROW AND UNBOUNDED FOLLOWING) AS rest FROM k{n})""")
    # setting one more cell aside raises the factor up to the right number of cells and lowers it beyond
    steps.append("f AS (SELECT max(remaining / rest) AS factor FROM o)")
    steps.append("p AS (SELECT source, lang, topic, least(1.0, ratio * factor) AS prob FROM o, f)")
    uniform = f"CAST(('0x' || substr(md5('{seed}:' || CAST(doc_id AS VARCHAR)), 1, 13)) AS BIGINT) / 4503599627370496.0"
    return "WITH " + ",\n".join(steps) + f"""
SELECT d.doc_id, d.source, d.lang, d.topic, d.n_tokens, round(coalesce(p.prob, 0.0), 9) AS prob,
  coalesce({uniform}, 0.0) < coalesce(p.prob, 0.0) AS sampled
FROM d LEFT JOIN p USING (source, lang, topic)"""
