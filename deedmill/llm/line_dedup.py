"""Lines that many documents share are dropped everywhere but in one document.

Built-in functions only. Lines are exploded with their positions, normalised and
hashed to 128 bits; a key's documents are counted by a distinct aggregate, which
reduces a common line to one row per document and then to one row per task
before its key decides where it goes. Lines of repeated keys come back as
positions per document, and the text is put together from the stretches between
them; no line of text is ever moved.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from deedmill.session import staged

WHITE_SPACE = " \t\n\x0b\x0c\r"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: Repeated keys up to which all of them are sent to every task: 24 bytes a row.
BROADCAST_KEYS = 200_000
#: Keys with more than this share of all repeated lines are looked up apart: fewer of them than its inverse.
HEAVY_SHARE = 1000
SPREAD = 2048


def ascii_lower(text: Column) -> Column:
    """A-Z lower-cased, all else as it is."""
    return F.when(F.octet_length(text) == F.length(text), F.lower(text)).otherwise(F.translate(text, UPPER, UPPER.lower()))


def _digest(*columns: Column) -> list[Column]:
    """128 bits as two numbers."""
    return [F.xxhash64(*columns), F.xxhash64(F.lit(1), *columns)]


def _keyed_lines(docs: DataFrame, min_chars: int) -> DataFrame:
    """``id``, digest of the whole text, position and digest of the key of every line that is long enough."""
    text = F.col("text")
    r1, r2 = _digest(text)
    lines = docs.select("id", r1.alias("r1"), r2.alias("r2"), F.posexplode(F.split(ascii_lower(text), "\n")).alias("pos", "line"))
    key = F.btrim("line", F.lit(WHITE_SPACE))
    h1, h2 = _digest(key)
    return lines.where(F.length(key) >= min_chars).select("id", "r1", "r2", "pos", h1.alias("h1"), h2.alias("h2"))


def _with_keeper(lines: DataFrame, keys: DataFrame) -> DataFrame:
    """Lines whose key is one of ``keys``, with the key's ``keeper``. A key with a large
    share of the lines takes it from a broadcast of the few such keys, and its lines are spread over the shuffle."""
    size = keys.agg(F.count("*").alias("n"), F.coalesce(F.sum("n_docs"), F.lit(0)).alias("held")).first()
    if size["n"] <= BROADCAST_KEYS:
        return lines.join(F.broadcast(keys.select("h1", "h2", "keeper")), ["h1", "h2"])
    # bounded: fewer than HEAVY_SHARE rows
    heavy = keys.where(F.col("n_docs") * HEAVY_SHARE > size["held"]).select("h1", "h2", F.col("keeper").alias("heavy_keeper"))
    marked = lines.join(F.broadcast(heavy), ["h1", "h2"], "left")
    apart = F.col("heavy_keeper").isNotNull()
    slot = F.when(apart, 1 + F.pmod(F.xxhash64("r1", "id", "pos"), F.lit(SPREAD))).otherwise(F.lit(0).cast("long"))
    place = lambda n: F.struct("h1", "h2", n.cast("long").alias("slot"))
    light = keys.select(place(F.lit(0)).alias("place"), "keeper")
    found = marked.withColumn("place", place(slot)).join(light, "place", "left")
    return found.withColumn("keeper", F.coalesce("heavy_keeper", "keeper")).where("keeper IS NOT NULL")


def _without(text: Column, positions: Column) -> Column:
    """``text`` without the lines at ``positions`` (ascending, from 0), from the stretches between them."""

    def stretches(s: Column) -> Column:
        before = lambda k: F.coalesce(F.get(s["p"], k - 1), F.lit(-1))
        after = lambda k: F.coalesce(F.get(s["p"], k), F.size(s["x"]))
        parts = F.transform(F.sequence(F.lit(0), F.size(s["p"])), lambda k: F.slice(s["x"], before(k) + 2, after(k) - before(k) - 1))
        return F.array_join(F.flatten(parts), "\n")

    # the outer transform binds the split lines once; named outside, they would be split anew for every stretch
    whole = F.array(F.struct(F.split(text, "\n").alias("x"), positions.alias("p")))
    return F.when(F.size(positions) == 0, text).otherwise(F.get(F.transform(whole, stretches), F.lit(0)))


def drop_repeated_lines(
    docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", min_chars: int = 20, min_docs: int = 3
) -> DataFrame:
    """One row per row of ``docs``: id, ``n_lines``, ``n_dropped`` and ``kept``, the text that stays.

    Lines end at ``\\n``. A line's key is the line without ASCII white space at
    its ends and with A-Z in lower case. Keys of ``min_chars`` code points or
    more that ``min_docs`` or more documents hold lose all their lines except in
    the document with the largest id, where all of them stay, also those that
    repeat. Documents are told apart by id: rows with one id are one document.

    Null and empty texts are one empty line. Rows without an id count as no
    document and keep no repeated line. Rows that are repeated stay repeated.
    Other columns are not read. An empty table gives an empty one.
    """
    docs = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    lines = _keyed_lines(docs, min_chars)
    counted = lines.groupBy("h1", "h2").agg(F.count_distinct("id").alias("n_docs"), F.max("id").alias("keeper"))
    keys = staged(counted.where(F.col("n_docs") >= min_docs), "repeated-lines")
    gone = _with_keeper(lines, keys).where(~F.col("id").eqNullSafe(F.col("keeper")))
    gone = gone.groupBy("id", "r1", "r2").agg(F.sort_array(F.collect_set("pos")).alias("gone"))
    gone = gone.select(F.col("id").alias("of"), "r1", "r2", "gone")
    r1, r2 = _digest(F.col("text"))
    rows = docs.withColumns({"d1": r1, "d2": r2})
    joined = rows.join(gone, rows["id"].eqNullSafe(gone["of"]) & (rows["d1"] == gone["r1"]) & (rows["d2"] == gone["r2"]), "left")
    positions = F.coalesce(F.col("gone"), F.array().cast("array<int>"))
    n_lines = F.length("text") - F.length(F.translate("text", "\n", "")) + 1
    return joined.select(
        F.col("id").alias(id_col),
        n_lines.cast("long").alias("n_lines"),
        F.size(positions).cast("long").alias("n_dropped"),
        _without(F.col("text"), positions).alias("kept"),
    )
