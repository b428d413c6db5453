"""Mix sources to target weights: rake token counts to marginals, then sample documents.

Documents are counted into cells (source, language, topic). Iterative proportional fitting scales
the cells' tokens until their sums over each dimension meet that dimension's target shares. A
document is drawn with the probability of its cell: target tokens over tokens there, times the
share of all tokens to draw; where that is above 1, the other cells are raked again. All sums are DataFrame aggregates, so a dimension may have any number
of values; the driver sees one number per sweep.
"""

from __future__ import annotations

import warnings
from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, functions as F

from lakesteps.llm.common import BLANKS, free_name, text_or_empty
from lakesteps.session import materialize

DIMENSIONS = ("source", "lang", "topic")
#: Target shares follow the observed shares to this power: 1 keeps them, 0 makes all equal.
TEMPER = {"source": 0.5, "lang": 0.7, "topic": 0.8}
RATE = 0.7
SWEEPS, TOLERANCE = 25, 1e-4
SEED = 20


def count_words(text: Column) -> Column:
    bare = F.btrim(text, F.lit(BLANKS))
    return F.when(bare == "", 0).otherwise(F.size(F.split(bare, "[ \\t-\\r]+"))).cast("long")


def register_topic(text: Column) -> Column:
    """A coarse topic by what the text talks about, for corpora without topic labels."""
    return (
        F.when(text.rlike(r"(?i)licen[sc]e|copyright|all rights reserved"), "legal")
        .when(text.rlike(r"[\w.]@\w+\.\w"), "contact")
        .when(text.rlike(r"(?i)\b(?:token|password|secret|api_?key)\b"), "technical")
        .when(text.rlike(r" \| [^|]* \| "), "tabular")
        .otherwise("prose"))


def tempered_targets(cells: DataFrame, powers: Mapping[str, float]) -> dict[str, DataFrame]:
    """Per dimension (value, share): observed token shares to a power, summing to 1."""
    targets = {}
    for dim, power in powers.items():
        sums = cells.groupBy(dim).agg(F.sum("tokens").alias("t")).where("t > 0").select(
            F.col(dim).alias("value"), F.pow("t", F.lit(float(power))).alias("share"))
        total = sums.agg(F.sum("share").alias("total"))
        targets[dim] = sums.select(
            "value", (F.col("share") / total.scalar()).alias("share"))
    return targets


def _with_goals(cells: DataFrame, goals: Mapping[str, DataFrame]) -> DataFrame:
    """``cells`` with a column goal_<dimension> for each of ``goals`` (dimension, goal), joined once for all sweeps."""
    for dim, goal in goals.items():
        cells = cells.join(goal.withColumnRenamed("goal", f"goal_{dim}"), dim, "left")
    return cells


def _step(cells: DataFrame, label: str) -> tuple[DataFrame, float]:
    """``cells`` written, and the most that any has ``moved``, taken as they are written.

    Cells are written after each dimension: a plan over several would hold every step twice for each
    that follows, and the driver keeps the plans.
    """
    seen = Observation()
    return materialize(cells.observe(seen, F.max("moved").alias("moved")), label), seen.get.get("moved") or 0.0


def rake(cells: DataFrame, targets: Mapping[str, DataFrame], sweeps: int = SWEEPS,
         tolerance: float = TOLERANCE) -> DataFrame:
    """``cells`` (dimensions, tokens) and ``fitted``: tokens scaled to the targets' shares.

    Shares of values that no cell has are spread over the others in proportion; values without a
    target get none. Sweeps end once no cell moved by more than ``tolerance`` of itself; a warning
    says if ``sweeps`` were not enough.
    """
    fixed = {}
    for dim, target in targets.items():
        present = cells.where("tokens > 0").groupBy(F.col(dim).alias("value")).agg(
            F.sum("tokens").alias("t"))
        met = present.join(target, "value", "left").select(
            "value", "t", F.coalesce("share", F.lit(0.0)).alias("share"))
        sums = met.agg(F.sum("share").alias("s"), F.sum("t").alias("t"))
        fixed[dim] = materialize(met.select(
            F.col("value").alias(dim), (F.col("share") / sums.select("s").scalar()
                                        * sums.select("t").scalar()).alias("goal")), "rake-target")
    now = materialize(_with_goals(cells, fixed).withColumns({
        "fitted": F.col("tokens").cast("double"), "moved": F.lit(0.0)}), "rake")
    for _ in range(sweeps):
        now = now.withColumn("moved", F.lit(0.0))
        for dim in fixed:
            factors = now.groupBy(dim).agg(F.sum("fitted").alias("sum"), F.max(f"goal_{dim}").alias("goal")).select(
                dim, F.when(F.col("sum") > 0, F.col("goal") / F.col("sum")).otherwise(0.0).alias("factor"))
            now, moved = _step(now.join(factors, dim, "left").withColumns({
                "fitted": F.col("fitted") * F.coalesce("factor", F.lit(0.0)),
                "moved": F.greatest("moved", F.when(F.col("fitted") > 0, F.abs(F.coalesce("factor", F.lit(0.0)) - 1))),
            }).drop("factor"), "rake")
        if not fixed or moved <= tolerance:
            break
    else:
        warnings.warn(f"raking ended after {sweeps} sweeps before cells came to rest")
    return now.drop("moved", *(f"goal_{dim}" for dim in fixed))


def _filled(rows: DataFrame, share: str, cap: str, budget: float) -> Column:
    """``share`` times one scale, at most ``cap``, such that all add up to ``budget`` if they can.

    What full rows leave goes to the others in proportion. The driver sees two numbers per step.
    """
    scale, amount = 1.0, F.col(share)
    while True:
        full = amount * scale >= F.col(cap)
        got = rows.agg(F.sum(F.when(full, F.col(cap))).alias("full"),
                       F.sum(F.when(~full, amount)).alias("open")).first()
        left = budget - (got["full"] or 0)
        new = left / got["open"] if got["open"] and left > 0 else scale
        if new <= scale * (1 + 1e-9):
            return F.least(F.col(cap).cast("double"), amount * scale)
        scale = new


def reachable_goals(fitted: DataFrame, dim: str, budget: float) -> DataFrame:
    """(value, tokens, target, goal) per value: its fitted tokens, and how many of ``budget`` to draw.

    As no document is drawn twice a value cannot give more than all its tokens; what it lacks
    goes to the other values in proportion to their targets.
    """
    sums = fitted.groupBy(F.col(dim).alias("value")).agg(
        F.sum("tokens").alias("tokens"), F.sum("fitted").alias("target"))
    whole = fitted.agg(F.sum("fitted")).first()[0] or 1.0
    sums = materialize(sums.withColumn("start", F.col("target") * (budget / whole)), "goals")
    return sums.withColumn("goal", _filled(sums, "start", "tokens", budget)).drop("start")


def draw_rates(fitted: DataFrame, rate: float = RATE, sweeps: int = SWEEPS,
               tolerance: float = TOLERANCE) -> DataFrame:
    """Add ``probability``, such that ``rate`` of all tokens are drawn and shares meet the targets.

    No document is drawn twice, so a cell gives at most all its tokens. Clipping and raking
    alternate: per dimension the open cells of a value are scaled to what its full cells leave of
    its goal (``reachable_goals``). Goals that no cells can meet together stay missed; a warning
    says so, and ``mixing_report`` by how much. Cells without tokens get the rate.
    """
    budget = rate * (fitted.agg(F.sum("tokens")).first()[0] or 0)
    whole = fitted.agg(F.sum("fitted")).first()[0] or 1.0
    goals = {dim: materialize(reachable_goals(fitted, dim, budget).select(
        F.col("value").alias(dim), "goal"), "goals") for dim in DIMENSIONS}
    cap, now = F.col("tokens").cast("double"), F.col("expected")
    cells = materialize(_with_goals(fitted, goals).withColumns({
        "expected": F.least(cap, F.col("fitted") * (budget / whole)), "moved": F.lit(0.0)}), "draw")
    for _ in range(sweeps):
        cells = cells.withColumn("moved", F.lit(0.0))
        for dim in goals:
            sums = cells.groupBy(dim).agg(
                F.sum("expected").alias("all"), F.max(f"goal_{dim}").alias("goal"),
                F.sum(F.when(now >= cap, now).otherwise(0.0)).alias("full"))
            less = F.col("goal") < F.col("all")
            factors = sums.select(
                dim, less.alias("less"), F.when(less, F.col("goal") / F.col("all")).when(
                    F.col("all") > F.col("full"), (F.col("goal") - F.col("full")) / (F.col("all") - F.col("full")))
                .otherwise(1.0).alias("factor"))
            step = cells.join(factors, dim, "left").withColumn("next", F.when(
                (now >= cap) & ~F.col("less"), now).otherwise(F.least(cap, now * F.col("factor"))))
            step = step.withColumn("moved", F.greatest("moved", F.when(
                now > 0, F.abs(F.col("next") / now - 1)).otherwise(0.0)))
            step = step.drop("expected", "less", "factor").withColumnRenamed("next", "expected")
            cells, moved = _step(step.select(cells.columns), "draw")
        if moved <= tolerance:
            break
    else:
        warnings.warn(f"draws do not meet all reachable targets: cells still move by {moved:.2g} of themselves")
    drawn = _filled(cells, "expected", "tokens", budget)
    return cells.withColumn("probability", F.round(F.when(cap > 0, F.least(F.lit(1.0), drawn / cap)).otherwise(
        F.lit(float(rate))), 9)).drop("expected", "moved", *(f"goal_{dim}" for dim in goals))


def mixing_report(plan: DataFrame, mixed: DataFrame | None = None, rate: float = RATE) -> DataFrame:
    """dimension, value, target, reachable, expected, and drawn if ``mixed`` is given: shares of tokens.

    ``plan`` is what ``sampling_plan`` gives, ``mixed`` what ``mix_documents`` gives. A share is
    null where nothing is drawn at all.
    """
    budget = rate * (plan.agg(F.sum("tokens")).first()[0] or 0)
    parts = []
    for dim in DIMENSIONS:
        aims = reachable_goals(plan, dim, budget).select("value", "target", F.col("goal").alias("reachable"))
        part = aims.join(plan.groupBy(F.col(dim).alias("value")).agg(
            F.sum(F.col("tokens") * F.col("probability")).alias("expected")), "value")
        if mixed is not None:
            part = part.join(mixed.groupBy(F.col(dim).alias("value")).agg(
                F.sum(F.when(F.col("selected"), F.col("n_tokens")).otherwise(0)).alias("drawn")), "value", "left")
        part = materialize(part, "report")
        sums = part.agg(*(F.sum(c).cast("double").alias(c) for c in part.columns[1:]))
        parts.append(part.select(F.lit(dim).alias("dimension"), "value", *(
            F.try_divide(F.col(c).cast("double"), sums.select(c).scalar()).alias(c) for c in part.columns[1:])))
    return reduce(DataFrame.unionByName, parts)


def _features(docs: DataFrame, text: str, source: str, lang: str, topic) -> dict[str, Column]:
    body = text_or_empty(text)
    name = lambda c: F.coalesce(F.col(f"`{c}`").cast("string"), F.lit(""))
    return {"source": name(source), "lang": name(lang), "topic": F.coalesce(topic(body), F.lit("")),
            "n_tokens": count_words(body)}


def document_features(docs: DataFrame, id: str = "doc_id", text: str = "text", source: str = "source",
                      lang: str = "lang", topic=register_topic) -> DataFrame:
    """id, source, lang, topic and n_tokens of each row, written once, as working them out reads whole texts."""
    f = _features(docs, text, source, lang, topic)
    return materialize(docs.select(F.col(f"`{id}`").alias("__id"), *(c.alias(k) for k, c in f.items())), "features")


def plan_of(rows: DataFrame, targets: Mapping[str, DataFrame] | None = None, rate: float = RATE) -> DataFrame:
    """``sampling_plan`` from rows that have source, lang, topic and n_tokens."""
    cells = materialize(rows.groupBy(*DIMENSIONS).agg(F.sum("n_tokens").alias("tokens")), "cells")
    goals = tempered_targets(cells, TEMPER) | dict(targets or {})
    return draw_rates(rake(cells, goals), rate)


def sampling_plan(docs: DataFrame, text: str = "text", source: str = "source", lang: str = "lang",
                  topic=register_topic, targets: Mapping[str, DataFrame] | None = None,
                  rate: float = RATE) -> DataFrame:
    """One row per cell: source, lang, topic, tokens, fitted, probability.

    ``targets`` holds (value, share) per dimension; those left out follow TEMPER. Null sources and
    languages are the value ''.
    """
    f = _features(docs, text, source, lang, topic)
    return plan_of(docs.select(*(c.alias(k) for k, c in f.items())), targets, rate)


def chance(id: Column, seed: int = SEED) -> Column:
    """A number in [0, 1) that depends on the id alone."""
    return F.pmod(F.xxhash64(id, F.lit(seed)), F.lit(1 << 53)) / F.lit(float(1 << 53))


def mix_documents(docs: DataFrame, id: str = "doc_id", text: str = "text", source: str = "source",
                  lang: str = "lang", topic=register_topic,
                  targets: Mapping[str, DataFrame] | None = None, rate: float = RATE,
                  seed: int = SEED) -> DataFrame:
    """One row per row of ``docs``: id, source, lang, topic, n_tokens, probability, selected.

    A document is selected if a number made of its id lies below its cell's probability, so rows
    that repeat an id within a cell share their fate, and a second run selects the same. Null or
    empty texts have no tokens. Null sources and languages appear as ''. Other columns are ignored.
    """
    rows = document_features(docs, id, text, source, lang, topic)
    plan = plan_of(rows, targets, rate)
    joined = rows.join(plan.select(*DIMENSIONS, "probability"), list(DIMENSIONS))
    return joined.select(
        F.col("__id").alias(id), *DIMENSIONS, "n_tokens", "probability",
        (chance(F.col("__id"), seed) < F.col("probability")).alias("selected"))


def sample_to_targets(docs: DataFrame, id: str = "doc_id", text: str = "text",
                      source: str = "source", lang: str = "lang", topic=register_topic,
                      targets: Mapping[str, DataFrame] | None = None, rate: float = RATE,
                      seed: int = SEED) -> DataFrame:
    """The selected rows of ``docs``, columns as they are."""
    plan = sampling_plan(docs, text, source, lang, topic, targets, rate)
    keys = {k: free_name(docs, f"__mix_{k}") for k in (*DIMENSIONS, "probability")}
    f = _features(docs, text, source, lang, topic)
    plan = plan.select(*(F.col(k).alias(v) for k, v in keys.items()))
    marked = docs.withColumns({keys[k]: f[k] for k in DIMENSIONS})
    joined = marked.join(plan, [keys[k] for k in DIMENSIONS])
    return joined.where(chance(F.col(f"`{id}`"), seed) < F.col(keys["probability"])).select(
        *(F.col(f"`{c}`") for c in docs.columns))
