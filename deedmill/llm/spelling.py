"""Spelling variants: words one edit apart, found by asymmetric chunks.

Of two words the shorter one (either, if equally long) is cut into two disjoint
chunks. One edit touches one of them at most, so the other stands unchanged in
the longer word, moved by the difference of the lengths: by one at most. So the
longer word puts its positional grams beside the chunks, those of the chunks'
lengths at the places that far away, and words meet by an equality join on
(length, place, gram). Pairs that meet are verified.

A chunk that very many words share would pair them all up. Such a group is not
paired: the rest of the word, which holds the edit, is cut into chunks of its
own, and all but one of these must be preserved as well. The edit's region so
shrinks to a code point, where a group holds no more words than the alphabet
lets differ in one place. Every pair is emitted once, in the region with its
first difference.

All of it runs on built-in functions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from deedmill.llm.line_dedup import ascii_lower
from deedmill.session import staged

#: Pairs that may meet in one group before its region is cut again.
GROUP_PAIRS = 512
#: Keys with more than this share of all rows are marked by a broadcast: fewer of them than its inverse.
HEAVY_SHARE = 1000
#: No key counts as such a one below these rows.
HEAVY_ROWS = 10_000
#: Pieces that a region is cut into at most, once it holds the edit of a large group.
PIECES = 4
RUN = r"[a-z\x{00C0}-\x{00FF}]"


def count_words(docs: DataFrame, *, id_col: str, text_col: str, min_chars: int, min_count: int, noise: int) -> DataFrame:
    """``word`` and ``n`` of the words of at least ``min_chars`` code points that occur ``min_count`` times or more.

    Only runs of ``min_chars`` letters or more are taken out of the texts: a run
    can become shorter but not longer.
    """
    runs = docs.select(
        F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("id"),
        F.explode(F.regexp_extract_all(ascii_lower(F.col(text_col)), F.lit(f"{RUN}{{{min_chars},}}"), F.lit(0))).alias("run"),
    )
    if noise:
        h = F.crc32(F.concat_ws(":", "id", "run").cast("binary"))
        at = F.pmod(F.col("h"), F.length("run")).cast("int")
        cut = F.concat(F.substring("run", F.lit(1), at), F.substring("run", at + 2, F.length("run")))
        runs = runs.withColumn("h", h).select(F.when(F.col("h") % noise == 0, cut).otherwise(F.col("run")).alias("run"))
        runs = runs.where(F.length("run") >= min_chars)
    return runs.groupBy(F.col("run").alias("word")).agg(F.count("*").alias("n")).where(F.col("n") >= min_count)


def _pieces(lo: Column, hi: Column, number: Column) -> Column:
    """The region from ``lo`` to ``hi`` in ``number`` pieces of about one size."""
    edge = lambda k: (lo + F.floor((hi - lo) * k / number)).cast("int")
    return F.transform(F.sequence(F.lit(0), number - 1), lambda k: F.struct(edge(k).alias("lo"), edge(k + 1).alias("hi")))


def _signatures(rows: DataFrame) -> DataFrame:
    """``key`` of each row: all that must be equal outside of the region, in a word of ``short`` code points."""
    after = F.col("hi") + F.col("size") - F.col("short") + 1
    outside = [F.substring("word", F.lit(1), F.col("lo")), F.substring("word", after, F.col("size"))]
    return rows.withColumn("key", F.xxhash64("short", "lo", "hi", *outside))


def _is_chunk() -> Column:
    """Whether the row stands for the shorter word of a pair."""
    return F.col("short") == F.col("size")


def _pairs(groups: DataFrame) -> DataFrame:
    """Verified pairs ``a``, ``b`` with their counts, from groups of a bounded size."""
    members = groups.groupBy("key").agg(F.collect_list(F.struct("word", "n", "size", "short", "lo", "hi")).alias("m"))
    x, y = F.col("x"), F.col("y")
    met = members.select("m", F.explode(F.filter("m", lambda w: w["short"] == w["size"])).alias("x"))
    met = met.select("x", F.explode("m").alias("y"))
    longer = y["size"] - x["size"]
    part = lambda w, more: F.substring(w["word"], x["lo"] + 1, x["hi"] - x["lo"] + more)
    verified = (
        # equally long words meet twice, and each with itself
        ((longer == 1) | (x["word"] < y["word"]))
        & (F.substring(x["word"], F.lit(1), x["lo"]) == F.substring(y["word"], F.lit(1), x["lo"]))
        & (F.substring(x["word"], x["hi"] + 1, x["size"]) == F.substring(y["word"], x["hi"] + longer + 1, y["size"]))
        # the first difference is in the region, or behind the shorter word
        & ((x["hi"] == x["size"]) | (part(x, F.lit(0)) != part(y, F.lit(0))))
        & (F.levenshtein(part(x, F.lit(0)), part(y, longer), 1) == 1)
    )
    return met.where(verified).select(
        x["word"].alias("a"), x["n"].alias("n_a"), y["word"].alias("b"), y["n"].alias("n_b")
    )


def near_pairs(words: DataFrame, min_chars: int) -> DataFrame:
    """Each pair of ``words`` that one edit turns into each other, once: ``a``, ``n_a``, ``b``, ``n_b``."""
    size = F.length("word")
    rows = words.select("word", "n", size.alias("size"), F.explode(F.array(size, size - 1)).alias("short"))
    rows = rows.where(F.col("short") >= min_chars).withColumn("r", F.explode(_pieces(F.lit(0), F.col("short"), F.lit(2))))
    rows = _signatures(rows.select("word", "n", "size", "short", "r.lo", "r.hi"))
    found = None
    while True:
        counts = rows.groupBy("key").agg(
            F.count("*").alias("held"), F.count_if(_is_chunk()).alias("chunks"), F.max(F.col("hi") - F.col("lo")).alias("width")
        )
        crowded = (F.col("held") * F.col("chunks") > GROUP_PAIRS) & (F.col("width") > 1)
        # a word's own gram meets its chunk: one other row at least makes a pair
        counts = counts.where((F.col("held") > 1) & (F.col("chunks") > 0)).select("key", "held", crowded.alias("crowded"))
        counts = staged(counts, "chunk-groups")
        total = counts.agg(F.coalesce(F.sum("held"), F.lit(0)), F.coalesce(F.max("crowded"), F.lit(False))).first()
        # bounded: fewer than HEAVY_SHARE rows, which also keep the largest groups out of the shuffle
        heavy = counts.where(F.col("crowded") & (F.col("held") > max(total[0] // HEAVY_SHARE, HEAVY_ROWS)))
        heavy = F.broadcast(heavy.select("key"))
        grouped = rows.join(heavy, "key", "left_anti").join(counts.select("key", "crowded"), "key")
        pairs = staged(_pairs(grouped.where("NOT crowded")), "near-words")
        found = pairs if found is None else found.unionByName(pairs)
        if not total[1]:
            return found
        columns = ("word", "n", "size", "short", "lo", "hi")
        again = grouped.where("crowded").select(*columns).unionByName(rows.join(heavy, "key", "left_semi").select(*columns))
        width = F.col("hi") - F.col("lo")
        number = F.least(F.lit(PIECES), F.when(width > 2, F.ceil(width / 2)).otherwise(width)).cast("int")
        again = again.withColumn("r", F.explode(_pieces(F.col("lo"), F.col("hi"), number)))
        rows = staged(_signatures(again.select("word", "n", "size", "short", "r.lo", "r.hi")), "chunks")


def _roots(forms: DataFrame) -> DataFrame:
    """``word`` and ``root``, where its chain of forms ends. A form occurs several times as
    often as its word, so chains are short; each round doubles the step."""
    steps = staged(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        ahead = steps.select(F.col("word").alias("root"), F.col("root").alias("further"))
        joined = staged(steps.join(ahead, "root", "left").select("word", F.coalesce("further", "root").alias("root"), "further"), "roots")
        moved = joined.where("further IS NOT NULL").isEmpty()
        steps = joined.select("word", "root")
        if moved:
            return steps


def spelling_forms(
    docs: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    min_chars: int = 7,
    min_count: int = 2,
    ratio: int = 10,
    noise: int = 0,
) -> DataFrame:
    """One row per word of ``docs``: ``word``, ``n``, ``n_near``, ``form``, ``form_n``, ``root``.

    Words are maximal runs of ``A-Za-z`` and U+00C0 to U+00FF, A-Z in lower case,
    of ``min_chars`` code points or more that occur ``min_count`` times or more.
    Two words are near if one inserted, deleted or replaced code point turns one
    into the other; ``n_near`` counts them. A word's ``form`` is its near word
    that occurs most often (ties: the first in code-point order) if that is at
    least ``ratio`` times as often as the word, else null; ``root`` is where
    following forms ends, the word itself if it has none.

    ``noise`` plants misspellings: a run whose crc32 with the row's id
    (``<id>:<run>``, a null id empty) it divides loses one code point. 0: none.

    Null and empty texts have no words, repeated rows count each, other columns
    are not read, an empty table gives an empty one. Words may be of any length.
    """
    words = count_words(docs, id_col=id_col, text_col=text_col, min_chars=min_chars, min_count=min_count, noise=noise)
    words = staged(words, "words")
    pairs = near_pairs(words, min_chars)
    ends = F.array(
        F.struct(F.col("a").alias("word"), F.col("n_a").alias("n"), F.col("b").alias("near"), F.col("n_b").alias("near_n")),
        F.struct(F.col("b").alias("word"), F.col("n_b").alias("n"), F.col("a").alias("near"), F.col("n_a").alias("near_n")),
    )
    near = pairs.select(F.explode(ends).alias("e")).select("e.*").groupBy("word", "n").agg(
        F.count("*").alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("less"), F.col("near").alias("form"))).alias("best")
    )
    often = -F.col("best.less") >= ratio * F.col("n")
    near = near.select(
        "word", "n_near", F.when(often, F.col("best.form")).alias("form"), F.when(often, -F.col("best.less")).alias("form_n")
    )
    near = staged(near, "forms")
    roots = _roots(near.where("form IS NOT NULL"))
    return words.join(near, "word", "left").join(roots, "word", "left").select(
        "word",
        "n",
        F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        "form",
        "form_n",
        F.coalesce("root", "word").alias("root"),
    )
