"""URL filters: host-suffix and path-prefix expressions, matched by short hash prefixes."""

from __future__ import annotations


from pyspark.sql import Column, DataFrame, SparkSession, functions as F

#: Hex digits of the digest that the join compares; the full digest is compared afterwards.
SHORT = 8
#: Rules that are sent to every task; more are joined by a shuffle.
BROADCAST_RULES = 100_000
#: Ways in which a pair of sides too large for that is spread over the shuffle.
SPREAD = 16


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; empty if there is no ``://``."""
    host = F.regexp_extract(F.coalesce(url, F.lit("")), r"^(?s:.*?)://([^/?#]*)", 1)
    return F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def path_of(url: Column) -> Column:
    """After the host up to ``?``, ``#`` or the end; empty if there is no ``://``."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"^(?s:.*?)://[^/?#]*([^?#]*)", 1)


def make_rules(spark: SparkSession, rules: list[tuple[str, str]]) -> DataFrame:
    """Rules from (``host/path``, verdict) pairs."""
    rows = [(r, r[: r.index("/")].lower(), r[r.index("/") :], v) for r, v in rules]
    return spark.createDataFrame(rows, "rule string, rule_host string, rule_path string, rule_verdict string")


def _anchor(path: Column) -> Column:
    """A path up to its last ``/``: what of a rule's path is looked up by hash."""
    return F.regexp_extract(path, r"^((?s:.*)/)?", 0)


def _digest(host: Column, path: Column) -> Column:
    return F.sha2(F.concat(host, F.lit("\n"), path), 256)


def judge_urls(
    pages: DataFrame,
    rules: DataFrame,
    *,
    id_col: str = "page_id",
    url_col: str = "url",
    default: str = "allow",
    broadcast_rules: int = BROADCAST_RULES,
) -> DataFrame:
    """One row per row of ``pages``: id, ``host``, ``path``, ``rule`` and ``verdict``.

    ``rules`` has ``rule``, ``rule_host``, ``rule_path`` and ``rule_verdict``. A
    rule fits its host and all subdomains if the path starts with the rule's; of
    the rules that fit, the one with the longest host and path wins, of equally
    long ones a blocking one, then the greater text. Without a rule the verdict
    is ``default`` (nothing is known against the page) and the rule null. A null
    url or one without ``://`` has an empty host and path and fits no rule but
    one of an empty host. Null and repeated ids keep a row each; other columns
    are not read.

    A url is expanded into its host suffixes times its path prefixes that end in
    ``/``, no deeper than the deepest rule, so that a very long url costs no more
    than the rules demand. Equal rows are expanded once.
    """
    keyed = rules.select("*", _anchor(F.col("rule_path")).alias("anchor")).withColumn(
        "full", _digest(F.col("rule_host"), F.col("anchor"))
    )
    keyed = keyed.select(
        "rule", "rule_verdict", "rule_host", "rule_path", "full", F.substring("full", 1, SHORT).alias("short")
    )
    # the depth of the rules: three numbers
    n_rules, host_depth, path_depth = rules.agg(
        F.count("*"),
        F.coalesce(F.max(F.size(F.split("rule_host", r"\."))), F.lit(1)),
        F.coalesce(F.max(F.size(F.split("rule_path", "/"))), F.lit(1)),
    ).first()

    rows = pages.groupBy(F.col(id_col).alias("id"), F.col(url_col).alias("url")).agg(F.count("*").alias("times"))
    rows = rows.select("id", "url", "times", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    labels = F.split("host", r"\.")
    suffixes = F.transform(
        F.sequence(F.lit(1), F.least(F.size(labels), F.lit(host_depth))),
        lambda k: F.call_function("substring_index", F.col("host"), F.lit("."), -k),
    )
    prefixes = F.transform(
        F.sequence(F.lit(0), F.least(F.size(F.split("path", "/")), F.lit(path_depth)) - 1),
        lambda k: F.when(k == 0, "").otherwise(F.concat(F.call_function("substring_index", F.col("path"), F.lit("/"), k), F.lit("/"))),
    )
    hosted = rows.select("*", F.explode(suffixes).alias("suffix"))
    expressions = hosted.select("*", F.explode(prefixes).alias("prefix")).withColumn(
        "url_full", _digest(F.col("suffix"), F.col("prefix"))
    )
    expressions = expressions.drop("suffix", "prefix").withColumn("url_short", F.substring("url_full", 1, SHORT))

    near = F.col("url_short") == F.col("short")
    if n_rules <= broadcast_rules:
        keyed = F.broadcast(keyed)
    else:
        # a suffix like com may stand in a third of all urls: its rules are repeated, the urls spread
        keyed = keyed.withColumn("spread", F.explode(F.sequence(F.lit(0), F.lit(SPREAD - 1))))
        expressions = expressions.withColumn("url_spread", F.pmod(F.xxhash64("id", "url"), F.lit(SPREAD)).cast("int"))
        near = near & (F.col("url_spread") == F.col("spread"))
    sure = (F.col("url_full") == F.col("full")) & F.startswith("path", "rule_path") & (
        (F.col("host") == F.col("rule_host")) | F.endswith("host", F.concat(F.lit("."), F.col("rule_host")))
    )
    matched = expressions.join(keyed, near & sure, "left")
    order = F.struct(
        F.length("rule_host") + F.length("rule_path"), (F.col("rule_verdict") == "block").alias("blocks"), F.col("rule")
    )
    best = matched.groupBy("id", "url", "times", "host", "path").agg(
        F.max(F.when(F.col("rule").isNotNull(), F.struct(order.alias("order"), "rule", "rule_verdict"))).alias("best")
    )
    return best.select(
        F.col("id").alias(id_col),
        "host",
        "path",
        F.col("best.rule").alias("rule"),
        F.coalesce("best.rule_verdict", F.lit(default)).alias("verdict"),
        F.explode(F.sequence(F.lit(1).cast("long"), F.col("times"))).alias("_nth"),
    ).drop("_nth")
