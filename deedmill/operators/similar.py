"""Names within a few edits of each other, all of them, without comparing all with all.

Two names k edits apart read the same once each has lost k characters at most, and so do
their beginnings of any one length: up to where the first of them ends, what the names do
not share are edits. So names meet by their beginnings with up to k characters left out,
which are as many for a long name as for a short one. Where very many meet, the group is
not paired but keyed again by longer beginnings. What is still crowded then is joined in
shares. Rows are moved by a number; names come back for the pairs that have met.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from deedmill.operators.skew import HOT_MIN_ROWS, lookup_left, salted_join
from deedmill.session import staged

#: Characters that a name needs for each edit.
CHARS_PER_EDIT = 4
#: Pairs of one group beyond which it is keyed anew.
GROUP_PAIRS = 1024
#: Lengths of the beginnings.
LEVELS = (12, 24, 48)


def clean_name(name: Column) -> Column:
    """Upper case, everything but letters and digits as one space, none at the ends."""
    return F.btrim(F.regexp_replace(F.upper(name), r"[^\p{L}\p{N}]+", " "))


def allowed_edits(name: Column, max_edits: int) -> Column:
    return F.least(F.lit(max_edits), F.floor(F.length(name) / CHARS_PER_EDIT)).cast("int")


def _numbers(name: Column) -> Column:
    """The numbers in a name: what differs in them is another name, not a misspelt one."""
    return F.btrim(F.regexp_replace(name, r"[^\p{N}]+", " "))


def _one_less(text: Column, start: Column) -> Column:
    """``text`` without one of its characters from ``start`` on, each with the place of the next that may go."""
    places = F.when(start <= F.length(text), F.sequence(start, F.length(text))).otherwise(F.array().cast("array<int>"))
    rest = lambda at: F.concat(F.substring(text, F.lit(1), at - 1), F.substring(text, at + 1, F.length(text)))
    return F.transform(places, lambda at: F.struct(rest(at).alias("text"), at.alias("start")))


def _shortened(text: Column, k: Column, most: int) -> Column:
    """``text`` in all ways to leave out up to ``k`` characters, ``most`` at most."""
    last = F.array(F.struct(text.alias("text"), F.lit(1).alias("start")))
    found = F.array(text)
    for left_out in range(1, most + 1):
        last = F.flatten(F.transform(F.when(k >= left_out, last).otherwise(F.slice(last, 1, 0)), lambda t: _one_less(t["text"], t["start"])))
        found = F.concat(found, F.transform(last, lambda t: t["text"]))
    return F.array_distinct(found)


def _keyed(rows: DataFrame, length: int, max_edits: int) -> DataFrame:
    """``key``, ``id`` and ``size`` for every way to shorten a name's beginning; names with other numbers have other keys."""
    texts = _shortened(F.substring("name", 1, length), F.col("k"), max_edits)
    shortened = rows.select("id", "size", _numbers(F.col("name")).alias("numbers"), F.explode(texts).alias("text"))
    return shortened.select(F.xxhash64("numbers", "text").alias("key"), "id", "size")


def _marked(keyed: DataFrame, counts: DataFrame, min_rows: int) -> DataFrame:
    """Rows whose key others hold too, with ``crowded``; keys with ``min_rows`` rows, which are few, stay out of the shuffle."""
    columns = [*keyed.columns, "crowded"]
    hot = counts.where(F.col("holders") >= min_rows)
    if hot.isEmpty():
        return keyed.join(counts, "key").select(*columns)
    cold = keyed.join(F.broadcast(hot.select("key")), "key", "left_anti").join(counts, "key")
    return cold.select(*columns).unionByName(keyed.join(F.broadcast(hot), "key").select(*columns))


def similar_names(names: DataFrame, max_edits: int = 2, **limits) -> DataFrame:
    """``a``, ``b`` and ``edits`` of all pairs of ``name`` that are 1 to k edits apart, each once, ``a`` before ``b``.

    k is ``max_edits``, or a quarter of the shorter name's length where that is
    less; names that hold other numbers are never a pair. Names must be distinct.
    Nothing in reach is missed. ``limits`` are those of the lookups.
    """
    sized = names.select(
        F.monotonically_increasing_id().alias("id"), "name", F.length("name").alias("size"), allowed_edits(F.col("name"), max_edits).alias("k")
    )
    sized = staged(sized.where("k > 0"), "name-ids")
    rows, met = sized, None
    for length in LEVELS:
        keyed = staged(_keyed(rows, length, max_edits), "name-keys")
        counts = keyed.groupBy("key").agg(F.count(F.lit(1)).alias("holders")).where("holders > 1")
        crowded = F.col("holders") * (F.col("holders") - 1) / 2 > GROUP_PAIRS
        counts = staged(counts.withColumn("crowded", crowded), "name-groups")
        marked = staged(_marked(keyed, counts, limits.get("min_rows", HOT_MIN_ROWS)), "name-marked")
        few = marked.where("NOT crowded").groupBy("key").agg(F.collect_list(F.struct("id", "size")).alias("m"))
        few = few.select("m", F.explode("m").alias("x")).select("x", F.explode("m").alias("y"))
        pairs = _apart(few.select(F.col("x.id").alias("x"), F.col("x.size").alias("x_size"), F.col("y.id").alias("y"), F.col("y.size").alias("y_size")), max_edits)
        met = pairs if met is None else met.unionByName(pairs)
        crowd = marked.where("crowded")
        if crowd.isEmpty():
            break
        if length == LEVELS[-1]:
            left = crowd.select("key", F.col("id").alias("x"), F.col("size").alias("x_size"))
            right = crowd.select("key", F.col("id").alias("y"), F.col("size").alias("y_size"))
            met = met.unionByName(_apart(salted_join(left, right, "key", F.col("x"), **limits), max_edits))
        rows = sized.join(crowd.select("id").distinct(), "id", "left_semi")
    return _found(staged(met.distinct(), "name-pairs"), sized, max_edits, **limits)


def _apart(met: DataFrame, max_edits: int) -> DataFrame:
    """Pairs whose lengths are near enough, the shorter name first; names of one length meet both ways round."""
    more = F.col("y_size") - F.col("x_size")
    return met.where(more.between(0, max_edits) & ((more > 0) | (F.col("x") < F.col("y")))).select("x", "y")


def _found(pairs: DataFrame, sized: DataFrame, max_edits: int, **limits) -> DataFrame:
    """Verified pairs of those that have met; the shorter name says how many edits are allowed."""
    shorter = sized.select(F.col("id").alias("x"), F.col("name").alias("x_name"), "k")
    longer = sized.select(F.col("id").alias("y"), F.col("name").alias("y_name"))
    named = lookup_left(pairs, shorter, "x", ["x_name", "k"], F.lit(True), F.col("y"), **limits)
    named = lookup_left(named, longer, "y", ["y_name"], F.lit(True), F.col("x"), **limits)
    near = named.withColumn("edits", F.levenshtein(F.col("x_name"), F.col("y_name"), max_edits))
    near = near.where((F.col("edits") > 0) & (F.col("edits") <= F.col("k")) & (_numbers(F.col("x_name")) == _numbers(F.col("y_name"))))
    return near.select(F.least("x_name", "y_name").alias("a"), F.greatest("x_name", "y_name").alias("b"), "edits")
