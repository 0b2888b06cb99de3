"""Mixing documents to target weights by iterative proportional fitting, on DataFrame functions only.

Token counts are summed to cells (source, language, topic). The cell weights are raked to the three
target marginals in turn until they settle. A document is then kept with a probability proportional
to weight / tokens of its cell, decided by a hash of its id, so that a rerun keeps the same rows.

Without a kept share the largest ratio gets probability one, so the scarcest cell for its target decides how
much of all others is kept. With one, the sample has that share of the tokens: categories and cells that
cannot give what their targets ask are kept whole, and the others make up for them.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ridewright.llm.common import free_name
from ridewright.session import cut_lineage

SWEEPS = 12
SWEEPS_PER_JOB = 6
TEMPERATURES = {"source": 0.5, "lang": 0.7, "topic": 0.7}
SMALL_CELLS = 100_000
SEED = "mix-1"


def token_count(text: Column) -> Column:
    """Tokens between white space; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def topic_of(text: Column) -> Column:
    """A coarse topic from the whole text: tables, licence notices, long and short prose."""
    text = F.coalesce(text, F.lit(""))
    return (
        F.when(text.contains(" | "), "table")
        .when(F.lower(text).contains("licen"), "notice")
        .when(F.length(text) >= 4000, "long prose")
        .when(F.length(text) >= 800, "prose")
        .otherwise("short")
    )


def uniform(key: Column, seed: str) -> Column:
    """A number in [0, 1) from the key; a null key counts as the empty text."""
    digest = F.md5(F.concat(F.coalesce(key.cast("string"), F.lit("")), F.lit("/" + seed)))
    return F.conv(F.substring(digest, 1, 12), 16, 10).cast("double") / F.lit(float(1 << 48))


def flattened(cells: DataFrame, dimension: str, temperature: float) -> DataFrame:
    """(category, share): token shares of the categories raised to a temperature, not yet scaled."""
    sums = cells.groupBy(F.col(dimension).alias("category")).agg(F.sum("tokens").alias("n"))
    return sums.select("category", F.pow("n", F.lit(temperature)).alias("share"))


def filled(rows: DataFrame, budget: float) -> DataFrame:
    """``rows`` (share, room) with amount: the least of room and a level times share, ``budget`` in all.

    The level rises while more rows are full; where no room is left, amounts sum to less than ``budget``.
    """
    share, room = F.col("share"), F.col("room")
    level, n_full = 0.0, -1
    while True:
        full = (share > 0) & (room <= F.lit(level) * share)
        sums = rows.agg(
            F.count_if(full).alias("n"),
            F.sum(F.when(full, room).otherwise(0.0)).alias("given"),
            F.sum(F.when(~full, share).otherwise(0.0)).alias("share"),
        ).first()
        if sums["n"] == n_full:
            break
        n_full = sums["n"]
        level = max(0.0, budget - sums["given"]) / sums["share"] if sums["share"] else float("inf")
    amount = F.when(share > 0, F.least(room, F.lit(level) * share)).otherwise(0.0)
    return rows.withColumn("amount", amount)


def rake(cells: DataFrame, targets: Mapping[str, DataFrame], sweeps: int = SWEEPS, budget: float | None = None) -> DataFrame:
    """The cells (dimensions, tokens) with a column weight whose marginals follow ``targets``.

    Each target lists (category, share) with one row per category; null is a category of its own.
    Categories that no cell has are left out, those without a target get share 0, and shares are scaled
    to sum to one over the categories present. Few cells are held in one partition, where the windows
    need no shuffle; a larger table is shuffled by each dimension in turn. Lineage is cut every few
    sweeps. With a ``budget`` the weights sum to it and none exceeds the tokens of its cell; a category whose
    goal exceeds its tokens gives them all, and the goals of the others rise in proportion.
    """
    total = cells.agg(F.sum("tokens")).first()[0] or 0.0
    out = cells.withColumn("weight", F.col("tokens"))
    for dimension, target in targets.items():
        present = cells.groupBy(F.col(dimension).alias("c")).agg(F.sum("tokens").alias("room"))
        present = cut_lineage(target.join(present, F.col("category").eqNullSafe(F.col("c"))).select("c", "share", "room"))
        if budget is None:
            shares = present.agg(F.sum("share")).first()[0] or 1.0
            goal = present.select("c", (F.col("share") / F.lit(shares) * F.lit(total)).alias(f"goal_{dimension}"))
        else:
            goal = filled(present, budget).select("c", F.col("amount").alias(f"goal_{dimension}"))
        out = out.join(goal, F.col(dimension).eqNullSafe(F.col("c")), "left").drop("c").fillna(0.0, [f"goal_{dimension}"])
    out = cut_lineage(out)
    if out.count() <= SMALL_CELLS:
        out = out.coalesce(1)
    for sweep in range(1, sweeps + 1):
        for dimension in targets:
            margin = F.sum("weight").over(Window.partitionBy(dimension))
            raised = F.when(margin > 0, F.col("weight") * F.col(f"goal_{dimension}") / margin).otherwise(0.0)
            out = out.withColumn("weight", raised if budget is None else F.least(raised, F.col("tokens")))
        if sweep % SWEEPS_PER_JOB == 0 or sweep == sweeps:
            out = cut_lineage(out)
    out = out.drop(*(f"goal_{d}" for d in targets))
    if budget is None:
        return out
    # what full cells could not take goes to the others in proportion
    left = out.withColumnsRenamed({"weight": "share", "tokens": "room"})
    return filled(left, budget).drop("share").withColumnsRenamed({"room": "tokens", "amount": "weight"})


def mix(
    docs: DataFrame,
    *,
    targets: Mapping[str, DataFrame] | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    lang_col: str = "lang",
    topic: Column | None = None,
    token_budget: float | None = None,
    kept_share: float | None = None,
    sweeps: int = SWEEPS,
    seed: str = SEED,
    prefix: str = "",
) -> DataFrame:
    """Every row of ``docs`` with topic, n_tokens, probability and kept (names behind ``prefix``).

    ``targets`` maps source, lang and topic to tables (category, share); a dimension without one takes
    the token shares of its categories, flattened by its temperature. Probabilities are scaled so that
    the largest is one, or lower where that would exceed ``token_budget`` expected tokens, so all
    marginals of the sample follow the targets in expectation; the scarcest cell bounds the whole sample
    then. ``kept_share`` asks for that share of all tokens instead (at most ``token_budget``): cells too
    small for their target are kept whole, the others follow the targets. Null categories form a category,
    null and empty texts have no tokens and are never kept, equal ids share their draw, and columns of
    ``docs`` named like a result are replaced.
    """
    names = {n: prefix + n for n in ("topic", "n_tokens", "probability", "kept")}
    text = F.col(text_col)
    marked = docs.withColumns({names["topic"]: topic if topic is not None else topic_of(text), names["n_tokens"]: token_count(text)})
    dimensions = {"source": source_col, "lang": lang_col, "topic": names["topic"]}
    cells = marked.groupBy([F.col(c).alias(d) for d, c in dimensions.items()])
    cells = cut_lineage(cells.agg(F.sum(names["n_tokens"]).cast("double").alias("tokens")).where("tokens > 0"))
    given = targets or {}
    goals = {d: given[d] if d in given else flattened(cells, d, TEMPERATURES[d]) for d in dimensions}
    budget = None
    if kept_share is not None:
        budget = kept_share * (cells.agg(F.sum("tokens")).first()[0] or 0.0)
        budget = budget if token_budget is None else min(budget, token_budget)
    raked = rake(cells, goals, sweeps, budget).withColumn("ratio", F.col("weight") / F.col("tokens"))
    number = raked.agg(F.max("ratio").alias("top"), F.sum("weight").alias("all"), F.count("*").alias("n")).first()
    scale = 1 / number["top"] if number["top"] else 0.0
    if budget is not None:
        scale = 1.0
    elif token_budget is not None and number["all"]:
        scale = min(scale, token_budget / number["all"])
    free = {n: free_name(marked.columns, f"__{n}") for n in (*dimensions, "chance")}
    chance = raked.select(*(F.col(d).alias(free[d]) for d in dimensions), (F.col("ratio") * scale).alias(free["chance"]))
    if number["n"] <= SMALL_CELLS:
        chance = F.broadcast(chance)
    same = [F.col(c).eqNullSafe(F.col(free[d])) for d, c in dimensions.items()]
    out = marked.join(chance, same[0] & same[1] & same[2], "left")
    chosen = F.when(F.col(names["n_tokens"]) > 0, F.coalesce(free["chance"], F.lit(0.0))).otherwise(0.0)
    out = out.withColumn(names["probability"], chosen).drop(*free.values())
    return out.withColumn(names["kept"], uniform(F.col(id_col), seed) < F.col(names["probability"]))
