"""Mixing sources to target weights by iterative proportional fitting. DataFrame functions only.

Documents are summed to cells (source, language, topic), one row for each
combination that occurs. The cells' token weights are raked: scaled in turn so
that the sums per source, per language and per topic meet their targets, until all
three hold. A document then is drawn in proportion to weight over tokens of its
cell, so that the expected tokens of the draw have the raked proportions. Where that
would leave too few of the tokens, documents of the most wanted cells are drawn
several times instead. How often a document is drawn depends on its id and text alone.
"""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from deedmill.llm.graph import gathered

#: Rounds of raking: at most, and between two looks at the margins.
ROUNDS, STEP = 60, 4
#: Relative change of every weight over a step that counts as settled.
CLOSE = 1e-6
#: Part of a target by which a value may miss it and counts as met.
MET = 1e-3
#: All tokens over those drawn at least once, at most: tiny cells are repeated and cannot press all others down.
MAX_RATIO = 2.5
#: Cells that are sent to every task; more are joined by a shuffle.
BROADCAST_CELLS = 100_000
#: Ways in which a hot cell is spread over that shuffle.
SPREAD = 16
_SPACES = " \t\n\x0b\x0c\r"


def word_count(text: Column) -> Column:
    trimmed = F.btrim(F.coalesce(text, F.lit("")), F.lit(_SPACES))
    return F.when(trimmed == "", 0).otherwise(F.size(F.split(trimmed, r"[\x20\x09-\x0D]+"))).cast("long")


def form_topic(text: Column) -> Column:
    """A topic by the form of a text, for corpora that come without one."""
    return (
        F.when(F.btrim(F.coalesce(text, F.lit("")), F.lit(_SPACES)) == "", "empty")
        .when(F.contains(text, F.lit(" | ")), "table")
        .when(F.length(text) < 400, "short")
        .when(F.length(text) < 4000, "medium")
        .otherwise("long")
    )


def margin(cells: DataFrame, by: str, *, power: float = 1.0, fixed: Mapping[str, float] | None = None) -> DataFrame:
    """Target share per value of a column: ``value``, ``share`` (sums to 1).

    Shares go by tokens to the ``power`` (below 1 lifts small values). Values in
    ``fixed`` get that weight instead, if they occur; the rest have what these
    leave of 1, or an equal part of everything if they leave nothing. A null
    value is a value.
    """
    sums = cells.groupBy(F.col(by).alias("value")).agg(F.sum("tokens").alias("tokens"))
    weight = F.pow(F.col("tokens").cast("double"), F.lit(power))
    named = F.lit(None).cast("double")
    for value, share in (fixed or {}).items():
        named = F.when(F.col("value") == value, F.lit(float(share))).otherwise(named)
    sums = sums.select("value", weight.alias("weight"), named.alias("named"))
    rest = F.col("named").isNull()
    # three numbers
    free, n_free, taken = sums.agg(
        F.sum(F.when(rest, F.col("weight"))), F.count(F.when(rest, F.lit(1))), F.sum("named")
    ).first()
    left = max(0.0, 1.0 - (taken or 0.0)) if n_free else 0.0
    if n_free and left == 0.0:
        left = (taken or 0.0) * n_free
    whole = (taken or 0.0) + left
    share = F.when(rest, F.col("weight") * (left / free if free else 0.0)).otherwise(F.col("named"))
    return sums.select("value", (share / (whole or 1.0)).alias("share"))


def rake(cells: DataFrame, margins: dict[str, DataFrame], max_ratio: float | None = None) -> DataFrame:
    """``cells`` (columns of ``margins`` and ``tokens``) with ``weight``, which sums to about 1.

    Cells without tokens keep weight 0. With ``max_ratio`` the weight of a cell is
    held to so many times its share of all tokens; what it lacks goes to others of
    the same value where they have room. Margins that contradict each other, which
    empty combinations and that bound can cause, end after ``ROUNDS`` rounds in the
    last state.
    """
    total = cells.agg(F.sum("tokens")).first()[0] or 1
    natural = F.col("tokens") / F.lit(float(total))
    state = cells.withColumn("weight", natural)
    for by, shares in margins.items():
        known = shares.select(F.col("value").alias("_value"), F.col("share").alias(f"share_{by}"))
        state = state.join(known, F.equal_null(by, "_value"), "left").drop("_value")
    state = gathered(state, "mix-cells")
    for _ in range(0, ROUNDS, STEP):
        state = state.withColumn("before", F.col("weight"))
        for _ in range(STEP):
            for by in margins:
                now = F.sum("weight").over(Window.partitionBy(by))
                state = state.withColumn(
                    "weight", F.when(now > 0, F.col("weight") * F.col(f"share_{by}") / now).otherwise(0.0)
                )
            if max_ratio is not None:
                state = state.withColumn("weight", F.least("weight", max_ratio * natural))
        state = gathered(state, "mix-cells")
        change = state.where("before > 0").agg(F.max(F.abs(F.col("weight") / F.col("before") - 1))).first()[0]
        if (change or 0.0) <= CLOSE:
            break
    return state.drop("before", *[f"share_{by}" for by in margins])


def targets(
    cells: DataFrame,
    *,
    source_power: float = 0.7,
    lang_power: float = 0.7,
    topic_power: float = 0.7,
    lang_shares: Mapping[str, float] | None = None,
) -> dict[str, DataFrame]:
    return {
        "source": margin(cells, "source", power=source_power),
        "lang": margin(cells, "lang", power=lang_power, fixed=lang_shares),
        "topic": margin(cells, "topic", power=topic_power),
    }


def reached(cells: DataFrame, margins: dict[str, DataFrame]) -> DataFrame:
    """``margin``, ``value``, ``natural``, ``target`` and ``reached`` share per value of raked ``cells``."""
    tokens, weight = cells.agg(F.sum("tokens"), F.sum("weight")).first()
    found = []
    for by, shares in margins.items():
        sums = cells.groupBy(F.col(by).alias("_value")).agg(F.sum("tokens").alias("tokens"), F.sum("weight").alias("weight"))
        found.append(
            sums.join(shares, F.equal_null("value", "_value")).select(
                F.lit(by).alias("margin"),
                "value",
                (F.col("tokens") / F.lit(float(tokens or 1))).alias("natural"),
                F.col("share").alias("target"),
                (F.col("weight") / F.lit(weight or 1.0)).alias("reached"),
            )
        )
    return reduce(DataFrame.union, found)


def draws_per_weight(cells: DataFrame) -> float:
    """Tokens to draw for weight 1, those of repeated documents included.

    As many as no cell has to be repeated for, if these are 1 / ``MAX_RATIO`` of
    all tokens or more. Else as many that, with cells repeated where all of their
    tokens are drawn, 1 / ``MAX_RATIO`` of all tokens are drawn at least once.
    """
    top, weights, tokens = cells.agg(F.max(F.col("weight") / F.col("tokens")), F.sum("weight"), F.sum("tokens")).first()
    if not tokens or not top:
        return 1.0
    if weights / top >= tokens / MAX_RATIO:
        return 1.0 / top
    # tokens drawn at least once are concave in the draws: Newton's steps from below meet the goal in some few rounds
    draws = tokens / MAX_RATIO / weights
    for _ in range(ROUNDS):
        all_drawn = F.col("weight") * F.lit(draws) >= F.col("tokens")
        full, free = cells.agg(F.sum(F.when(all_drawn, F.col("tokens"))), F.sum(F.when(~all_drawn, F.col("weight")))).first()
        before, draws = draws, (tokens / MAX_RATIO - (full or 0)) / free if free else draws
        if draws <= before * (1 + 1e-12):
            break
    return draws


def mix(
    docs: DataFrame,
    *,
    keep_cols: list[str] | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    lang_col: str = "lang",
    source_power: float = 0.7,
    lang_power: float = 0.7,
    topic_power: float = 0.7,
    lang_shares: Mapping[str, float] | None = None,
    seed: int = 0,
    broadcast_cells: int = BROADCAST_CELLS,
) -> DataFrame:
    """One row per row of ``docs``: ``keep_cols``, ``topic``, ``n_tokens``, ``cell_weight``, ``probability``, ``sampled``, ``expected`` and ``copies``.

    Tokens are words. Null sources and languages are values of their own; null,
    empty and blank texts have topic ``empty``, no tokens and probability 0. Rows equal
    in id and text share their fate; a null id counts as a value. A row is drawn
    ``copies`` times, ``expected`` on average (a whole number or the next), and
    tokens times copies have the target shares. Where cells held to ``MAX_RATIO``
    times their natural share meet every target, no row has two. The cell with the largest ratio of
    weight to tokens is expected once and the others in proportion, unless that
    leaves less than 1 / ``MAX_RATIO`` of all tokens; then as many are drawn at
    least once and rows of cells wanted most have several copies. ``probability``
    is that of one copy or more, which is ``sampled``. ``keep_cols`` (default: the
    id) may be any columns of ``docs``; others are not read.
    """
    keep = keep_cols or [id_col]
    drawn = F.pmod(F.xxhash64(id_col, text_col, F.lit(seed)), F.lit(1 << 52)) / float(1 << 52)
    rows = docs.select(
        *[F.col(c).alias(f"keep_{c}") for c in keep],
        F.col(source_col).alias("source"),
        F.col(lang_col).alias("lang"),
        form_topic(F.col(text_col)).alias("topic"),
        word_count(F.col(text_col)).alias("tokens"),
        drawn.alias("drawn"),
    )
    cells = gathered(rows.groupBy("source", "lang", "topic").agg(F.sum("tokens").alias("tokens")), "mix-sums")
    counted = cells.where("tokens > 0")
    margins = targets(
        counted, source_power=source_power, lang_power=lang_power, topic_power=topic_power, lang_shares=lang_shares
    )
    # no copies where single rows can meet every target
    raked = rake(counted, margins, MAX_RATIO)
    if not reached(raked, margins).where(F.abs(F.col("reached") - F.col("target")) > MET * F.col("target")).isEmpty():
        raked = rake(counted, margins)
    draws = draws_per_weight(raked)
    named = raked.select(
        F.col("source").alias("_s"),
        F.col("lang").alias("_l"),
        F.col("topic").alias("_t"),
        "weight",
        F.round(F.col("weight") / F.col("tokens") * F.lit(draws), 12).alias("times"),
    )
    same = F.equal_null("source", "_s") & F.equal_null("lang", "_l") & (F.col("topic") == F.col("_t"))
    if named.count() <= broadcast_cells:
        named = F.broadcast(named)
    else:
        named = named.withColumn("_k", F.explode(F.sequence(F.lit(0), F.lit(SPREAD - 1))))
        same = same & (F.floor(F.col("drawn") * SPREAD).cast("int") == F.col("_k"))
    times = F.coalesce("times", F.lit(0.0))
    copies = F.floor(times) + (F.col("drawn") < times - F.floor(times)).cast("long")
    return rows.join(named, same, "left").select(
        *[F.col(f"keep_{c}").alias(c) for c in keep],
        "topic",
        F.col("tokens").alias("n_tokens"),
        F.round(F.coalesce("weight", F.lit(0.0)), 12).alias("cell_weight"),
        F.least(F.lit(1.0), times).alias("probability"),
        (F.col("drawn") < times).alias("sampled"),
        times.alias("expected"),
        copies.alias("copies"),
    )
