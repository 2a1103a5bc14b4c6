"""Quality rules whose cutoffs come from mergeable quantile sketches per language and source.

DataFrame functions only. A sketch is a table of counts per bucket of a log-linear
scale (64 exact small values, then 32 buckets to each power of two: 3% relative
error). Its buckets are integers, so sketches merge by adding counts, in any order,
to the very same result; a lost task changes nothing. One sketch has at most some
1,900 buckets, whatever the number of documents.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from deedmill.session import staged

SPACE = "\\x20\\x09-\\x0D"
_SPACES = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"


@dataclass(frozen=True)
class Rule:
    """A metric (whole number), the quantile that ends its usual range, and how far beyond that is too far.

    With m the median of a group and q its quantile ``at`` (per thousand), the
    reach is ``(q - m) * (100 + beyond) / 100 + slack``; rejected is a value above
    m plus the reach and, if ``both``, one as far below by the opposite quantile.
    """

    metric: str
    at: int
    beyond: int
    slack: int = 25
    both: bool = False


#: Metrics are per thousand, word length in hundredths of a character.
RULES = (
    Rule("symbols_per_word", at=900, beyond=100),
    Rule("duplicate_lines", at=990, beyond=25),
    Rule("repeated_words", at=990, beyond=100),
    Rule("word_length", at=900, beyond=400, both=True),
)
#: A group's reach is at most so many times that of its language, and a language's of that of all documents.
WIDER = 2
#: Documents past the base rules that a group needs for thresholds of its own; below, those of its language count, then those of all.
MIN_DOCS = 100
#: Groups whose thresholds are sent to every task; more are joined by a shuffle.
BROADCAST_GROUPS = 100_000


# ---- statistics of a text --------------------------------------------------------


def text_stats(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` with ``n_words``, ``word_chars``, ``n_symbols``, ``n_lines``, ``n_dup_lines``, ``n_repeat_words``.

    Existing columns of these names are replaced and the text column is dropped.
    Null texts count as empty. Every step works inside the row, in time n log n.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    lines = F.filter(F.split(text, "\n"), lambda line: line.rlike(f"[^{SPACE}]"))
    trimmed = F.btrim(text, F.lit(_SPACES))
    df = docs.withColumns(
        {
            "_words": F.when(trimmed == "", F.array().cast("array<string>")).otherwise(
                F.split(trimmed, f"[{SPACE}]+")
            ),
            "_lines": lines,
            "word_chars": F.length(F.translate(text, _SPACES, "")).cast("long"),
            "n_symbols": (F.length(text) - F.length(F.translate(text, SYMBOLS, ""))).cast("long"),
        }
    ).drop(text_col)
    df = df.withColumns(
        {
            "n_words": F.size("_words").cast("long"),
            "n_lines": F.size("_lines").cast("long"),
            "n_dup_lines": (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long"),
            "_windows": F.when(
                F.size("_words") >= 3,
                F.transform(
                    F.sequence(F.lit(0), F.size("_words") - 3),
                    lambda i: F.xxhash64(
                        F.get(F.col("_words"), i), F.get(F.col("_words"), i + 1), F.get(F.col("_words"), i + 2)
                    ),
                ),
            ).otherwise(F.array().cast("array<bigint>")),
        }
    ).drop("_words", "_lines")
    return _repeat_words(df).drop("_windows")


def _repeat_words(df: DataFrame) -> DataFrame:
    """``n_repeat_words``: words in windows whose hash occurs twice or more.

    Windows are sorted by (upper bits of the hash, position) packed in one number;
    a window is repeated if it equals a neighbour there, by its full hash.
    """
    windows = F.col("_windows")
    df = df.withColumn("_mask", F.expr("shiftleft(1L, length(bin(size(_windows)))) - 1L")).withColumn(
        "_sorted",
        F.when(
            F.size(windows) > F.size(F.array_distinct(windows)),
            F.sort_array(
                F.transform(
                    windows,
                    lambda h, i: h.bitwiseAND(F.bitwise_not(F.col("_mask"))).bitwiseOR(i.cast("long")),
                )
            ),
        ),
    )

    def start(at: Column) -> Column:
        return F.get(F.col("_sorted"), at).bitwiseAND(F.col("_mask")).cast("int")

    def hash_at(at: Column) -> Column:
        return F.get(windows, start(at))

    df = df.withColumn(
        "_starts",
        F.sort_array(
            F.filter(
                F.transform(
                    F.col("_sorted"),
                    lambda _, k: F.when(
                        F.equal_null(hash_at(k), hash_at(k + 1)) | F.equal_null(hash_at(k), hash_at(k - 1)),
                        start(k),
                    ),
                ),
                lambda s: s.isNotNull(),
            )
        ),
    )
    starts = F.col("_starts")
    covered = F.aggregate(
        F.transform(starts, lambda s, k: F.least(F.lit(3), F.coalesce(F.get(starts, k + 1) - s, F.lit(3)))),
        F.lit(0).cast("long"),
        lambda total, n: total + n,
    )
    return df.withColumn("n_repeat_words", F.coalesce(covered, F.lit(0).cast("long"))).drop(
        "_mask", "_sorted", "_starts"
    )


def base_failed() -> Column:
    return (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


def metrics() -> dict[str, Column]:
    """The metrics of ``RULES``, of the columns of ``text_stats``; 0 for texts without words."""
    words, lines = F.greatest("n_words", F.lit(1)), F.greatest("n_lines", F.lit(1))
    return {
        "symbols_per_word": F.floor(1000 * F.col("n_symbols") / words),
        "duplicate_lines": F.floor(1000 * F.col("n_dup_lines") / lines),
        "repeated_words": F.floor(1000 * F.col("n_repeat_words") / words),
        "word_length": F.floor(100 * F.col("word_chars") / words),
    }


# ---- sketches --------------------------------------------------------------------


def bucket(value: Column) -> Column:
    """Bucket of a whole number >= 0: itself below 64, else 64 times its shift plus its upper 6 bits."""
    shift = F.length(F.bin(value)) - 6
    return F.when(value < 64, value).otherwise(64 * shift + F.call_function("shiftright", value, shift)).cast("long")


def bucket_low(b: Column) -> Column:
    """The least number of a bucket."""
    return F.call_function("shiftleft", F.when(b < 64, b).otherwise(b % 64), F.floor(b / 64).cast("int")).cast("long")


def sketch(stats: DataFrame, by: list[str]) -> DataFrame:
    """``n`` per group, metric and bucket."""
    cells = F.explode(
        F.array(*[F.struct(F.lit(r.metric).alias("metric"), bucket(F.col(r.metric)).alias("bucket")) for r in RULES])
    )
    return (
        stats.select(*by, cells.alias("cell"))
        .groupBy(*by, F.col("cell.metric").alias("metric"), F.col("cell.bucket").alias("bucket"))
        .agg(F.count("*").alias("n"))
    )


def merge_sketches(sketches: DataFrame, by: list[str]) -> DataFrame:
    """Sketches of coarser groups."""
    return sketches.groupBy(*by, "metric", "bucket").agg(F.sum("n").alias("n"))


def quantiles(sketches: DataFrame, by: list[str]) -> DataFrame:
    """Per group and metric ``total`` documents, the median ``mid``, and how far the rule lets a value be ``above`` and ``below`` it.

    Quantiles are the least values of the buckets that hold them.
    """
    group = Window.partitionBy(*by, "metric")
    upto = group.orderBy("bucket").rowsBetween(Window.unboundedPreceding, 0)
    ranked = sketches.withColumns({"total": F.sum("n").over(group), "upto": F.sum("n").over(upto)})
    low = bucket_low(F.col("bucket"))

    def pick(of) -> Column:
        """A number that depends on the rule of the row's metric."""
        return F.coalesce(*[F.when(F.col("metric") == r.metric, F.lit(of(r))) for r in RULES])

    at = lambda rank: F.min(F.when(1000 * F.col("upto") >= rank * F.col("total"), low))
    found = ranked.groupBy(*by, "metric").agg(
        F.max("total").alias("total"),
        at(F.lit(500)).alias("mid"),
        at(pick(lambda r: r.at)).alias("upper"),
        at(pick(lambda r: 1000 - r.at)).alias("lower"),
    )
    reach = lambda far: F.floor(far * (100 + pick(lambda r: r.beyond)) / 100) + pick(lambda r: r.slack)
    return found.select(
        *by, "metric", "total", "mid",
        reach(F.col("upper") - F.col("mid")).alias("above"), reach(F.col("mid") - F.col("lower")).alias("below"),
    )


def thresholds(stats: DataFrame, *, lang_col: str = "lang", source_col: str = "source") -> DataFrame:
    """``low_<metric>`` and ``high_<metric>`` per language and source, for every one that ``stats`` has.

    Sketches hold the documents that pass the base rules, so what is plainly
    junk does not move the cutoffs; a group in which much of the rest is junk is held to
    ``WIDER`` times the reach of its language, and that to as much of all
    documents'. Groups of fewer than ``MIN_DOCS`` such documents take the
    thresholds of their language, and those of all where the language has too
    few as well; without any document past the base rules nothing is cut off. A
    null language or source is a group like any other. ``stats`` wants to be a
    stored table: it is read several times, each time in part.
    """
    by = [lang_col, source_col]
    groups = stats.select(*by).distinct()
    fine = staged(sketch(stats.where(~base_failed()), by), "quality-sketch")

    def named(df: DataFrame, level: str, keys: list[str]) -> DataFrame:
        columns = [F.col(c).alias(f"{level}_{c}") for c in ("metric", "total", "mid", "above", "below")]
        return staged(df.select(*[F.col(k).alias(f"_{level}_{k}") for k in keys], *columns), f"quality-{level}")

    own = named(quantiles(fine, by), "own", by)
    wide = named(quantiles(merge_sketches(fine, [lang_col]), [lang_col]), "lang", [lang_col])
    every = named(quantiles(merge_sketches(fine, []), []), "all", [])
    metric = F.explode(F.array(*[F.lit(r.metric) for r in RULES])).alias("metric")
    joined = (
        groups.select(*by, metric)
        .join(every, F.col("metric") == F.col("all_metric"), "left")
        .join(wide, F.equal_null(lang_col, f"_lang_{lang_col}") & (F.col("metric") == F.col("lang_metric")), "left")
        .join(
            own,
            F.equal_null(lang_col, f"_own_{lang_col}") & F.equal_null(source_col, f"_own_{source_col}") & (F.col("metric") == F.col("own_metric")),
            "left",
        )
    )
    lang_has, own_has = F.col("lang_total") >= MIN_DOCS, F.col("own_total") >= MIN_DOCS
    mid = F.when(own_has, F.col("own_mid")).when(lang_has, F.col("lang_mid")).otherwise(F.col("all_mid"))

    def reach(side: str) -> Column:
        of_lang = F.when(lang_has, F.least(f"lang_{side}", WIDER * F.col(f"all_{side}"))).otherwise(F.col(f"all_{side}"))
        return F.when(own_has, F.least(F.col(f"own_{side}"), WIDER * of_lang)).otherwise(of_lang)

    cut = joined.select(*by, "metric", (mid + reach("above")).alias("high"), (mid - reach("below")).alias("low"))
    bounds = []
    for r in RULES:
        mine = F.col("metric") == r.metric
        bounds.append(F.max(F.when(mine, F.col("high"))).alias(f"high_{r.metric}"))
        if r.both:
            bounds.append(F.max(F.when(mine, F.col("low"))).alias(f"low_{r.metric}"))
    return cut.groupBy(*by).agg(*bounds)


# ---- the operator ----------------------------------------------------------------


def judge(
    docs: DataFrame, keep_cols: list[str], *, text_col: str = "text", lang_col: str = "lang", source_col: str = "source"
) -> DataFrame:
    """One row per row of ``docs``: ``keep_cols``, the statistics of its text, ``base_failed`` and ``kept``.

    ``kept`` is false for texts that fail the base rules and for those with a
    metric beyond the thresholds of their language and source. Null and empty
    texts have no words and so fail the base rules. Repeated rows are judged
    alike, each with a row of its own; columns other than those named are not
    read. Thresholds come from all rows that pass the base rules.
    """
    stats = text_stats(
        docs.select(
            *[F.col(c).alias(f"keep_{c}") for c in keep_cols],
            F.col(text_col).alias("_text"),
            F.col(lang_col).alias("_lang"),
            F.col(source_col).alias("_source"),
        ),
        "_text",
    )
    # the texts are read once: sketches and verdicts both start from the small table of statistics
    stats = staged(stats.withColumns(metrics()), "quality-stats")
    cuts = thresholds(stats, lang_col="_lang", source_col="_source").select(
        F.col("_lang").alias("_l"), F.col("_source").alias("_s"), F.col("*")
    ).drop("_lang", "_source")
    cuts = staged(cuts, "quality-cuts")
    if cuts.count() <= BROADCAST_GROUPS:
        cuts = F.broadcast(cuts)  # so that kept columns, texts perhaps, stay where they are
    judged = stats.join(cuts, F.equal_null("_lang", "_l") & F.equal_null("_source", "_s"), "left")
    inside = reduce(
        lambda a, b: a & b,
        [F.col(r.metric) <= F.col(f"high_{r.metric}") for r in RULES]
        + [F.col(r.metric) >= F.col(f"low_{r.metric}") for r in RULES if r.both],
    )
    return judged.select(
        *[F.col(f"keep_{c}").alias(c) for c in keep_cols],
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        base_failed().alias("base_failed"),
        (~base_failed() & inside).alias("kept"),
    )
