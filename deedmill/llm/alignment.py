"""Which tokens of two tokenizers end together, and how often two ids do so in the whole corpus.

An Arrow pipeline inside of Spark's tasks: ids are list arrays; flattened lists
and parent indices turn them into tables of tokens; cumulative sums of the
tokens' byte lengths, taken anew in every document, give their ends; a hash join
on (document, end) gives the links; group-by tables count id pairs per document
and per task. Spark merges the counts and hands them back to the documents.

A link's tokens end at the same byte, so one of the two is a suffix of the other.
The table of counts has therefore at most one row per token and suffix of it:
less than the two vocabularies have bytes, whatever the corpus. That is why it
may be broadcast.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F, types as T

from deedmill.llm.token_counts import chunks
from deedmill.llm.token_files import TextEncoder
from deedmill.llm.tokenizers import Units
from deedmill.session import staged

#: Characters of text that are held as Arrow tables at once.
CHUNK_CHARS = 2_000_000
#: Rows of counts that a task merges before it goes on.
MERGE_ROWS = 2_000_000


class ByteTokens:
    """Tokenizer A: a byte-level BPE file; texts get a space in front, special tokens are plain text."""

    def __init__(self, path: str):
        units = Units(path)
        units.library.encode_special_tokens = True
        # no string is an added token any more: neither when texts are split nor when units are merged
        units.added, units.hints = {}, ()
        self.encoder = TextEncoder(path, units)
        self.pieces = pa.array(units.pieces(), pa.binary())

    def encode(self, texts: list[str]) -> pa.ListArray:
        ids, sizes = self.encoder([" " + t for t in texts], None)
        return pa.ListArray.from_arrays(np.r_[0, np.cumsum(sizes)].astype(np.int32), pa.array(ids.astype(np.int32)))


class PieceTokens:
    """Tokenizer B: a sentencepiece model, which puts the space itself."""

    def __init__(self, path: str):
        import sentencepiece

        self.library = sentencepiece.SentencePieceProcessor(model_file=path)
        self.pieces = pa.array([self._bytes(k) for k in range(self.library.get_piece_size())], pa.binary())

    def _bytes(self, k: int) -> bytes:
        piece = self.library.id_to_piece(k)
        return bytes([int(piece[3:-1], 16)]) if self.library.is_byte(k) else piece.replace("▁", " ").encode()

    def encode(self, texts: list[str]) -> pa.ListArray:
        return pa.array(self.library.encode(texts, num_threads=1), pa.list_(pa.int32()))


class Aligner:
    """Both tokenizers of a worker."""

    def __init__(self, path_a: str, path_b: str):
        self.sides = (ByteTokens(path_a), PieceTokens(path_b))
        self.width = len(self.sides[1].pieces)
        self.lengths = [pc.binary_length(s.pieces).cast(pa.int64()) for s in self.sides]
        self.names = [pa.array(list(map(str, range(len(s.pieces))))) for s in self.sides]
        if any(pc.min(n).as_py() == 0 for n in self.lengths):
            raise ValueError("a piece without bytes has no end of its own")

    def _spells(self, side: int, ids: pa.ListArray, wanted: list[bytes]) -> np.ndarray:
        """Whether the joined pieces of each text are its bytes."""
        joined = self.sides[side].pieces.take(pc.list_flatten(ids))
        ends = np.r_[0, np.cumsum(self.lengths[side].take(pc.list_flatten(ids)).to_numpy(zero_copy_only=False))]
        data = memoryview(joined.buffers()[2] or b"").cast("B")
        edges = ends[ids.offsets.to_numpy()]
        return np.array([data[a:b] == w for a, b, w in zip(edges[:-1], edges[1:], wanted)], bool)

    def _tokens(self, side: int, ids: pa.ListArray) -> pa.Table:
        """One row per token: its document's place, its own place, its id and the byte of the document that it ends at."""
        flat, doc = pc.list_flatten(ids), pc.list_parent_indices(ids)
        ends = pc.cumulative_sum(self.lengths[side].take(flat))
        # segmented: what the documents before have is taken off
        before = np.r_[0, ends.to_numpy()][ids.offsets.to_numpy()[:-1]]
        ends = pc.subtract(ends, pa.array(before, pa.int64()).take(doc))
        return pa.table({"doc": doc.cast(pa.int64()), "end": ends, "at": pa.array(np.arange(len(flat))), "id": flat})

    @staticmethod
    def _grouped_names(names: pa.Array, ids: pa.Array, last: np.ndarray) -> pa.Array:
        """Ids between the tokens that end groups, joined by commas."""
        return pc.binary_join(pa.ListArray.from_arrays(np.r_[0, last + 1].astype(np.int32), names.take(ids)), ",")

    def __call__(self, texts: list[str]) -> dict[str, pa.Array]:
        """Columns of results, one row per text."""
        wanted = [b" " + t.encode() if t else b"" for t in texts]
        ids = [s.encode(texts) for s in self.sides]
        good = np.array([bool(t) for t in texts], bool)
        for side in (0, 1):
            good &= self._spells(side, ids[side], wanted)
        ids = [i.filter(pa.array(good)) for i in ids]
        n = int(good.sum())
        a, b = (self._tokens(side, i) for side, i in enumerate(ids))
        links = a.join(b.rename_columns(["doc", "end", "at_b", "id_b"]), ["doc", "end"], join_type="inner", use_threads=False)
        links = links.sort_by([("doc", "ascending"), ("end", "ascending")])
        doc = links["doc"].to_numpy()
        n_links = np.bincount(doc, minlength=n)
        # a document's last tokens end together, so groups never reach into the next one
        groups = pc.binary_join_element_wise(
            self._grouped_names(self.names[0], a["id"].combine_chunks(), links["at"].to_numpy()),
            self._grouped_names(self.names[1], b["id"].combine_chunks(), links["at_b"].to_numpy()),
            "|",
        )
        written = pc.binary_join(pa.ListArray.from_arrays(np.r_[0, np.cumsum(n_links)].astype(np.int32), groups), ";")
        pair = pc.add(pc.multiply(links["id"].cast(pa.int64()), self.width), links["id_b"].cast(pa.int64()))
        pairs = pa.table({"doc": links["doc"], "pair": pair}).group_by(["doc", "pair"], use_threads=False)
        pairs = pairs.aggregate([([], "count_all")]).sort_by([("doc", "ascending"), ("pair", "ascending")])

        def spread(values: np.ndarray) -> np.ndarray:
            out = np.zeros(len(texts), np.int64)
            out[good] = values
            return out

        digests = np.full(len(texts), "", object)
        digests[good] = [hashlib.sha256(w.as_buffer()).hexdigest() for w in written]
        starts = np.r_[0, np.cumsum(spread(np.bincount(pairs["doc"].to_numpy(), minlength=n)))].astype(np.int32)
        as_list = lambda column: pa.ListArray.from_arrays(starts, pairs[column].combine_chunks().cast(pa.int64()))
        return {
            "n_a": pa.array(spread(pc.list_value_length(ids[0]).to_numpy())),
            "n_b": pa.array(spread(pc.list_value_length(ids[1]).to_numpy())),
            "n_groups": pa.array(spread(n_links)),
            "n_links": pa.array(spread(n_links)),
            "groups_sha256": pa.array(digests.tolist(), pa.string()),
            "pairs": as_list("pair"),
            "times": as_list("count_all"),
        }


@lru_cache(maxsize=2)
def load_aligner(path_a: str, path_b: str) -> Aligner:
    """Once per Python process."""
    return Aligner(path_a, path_b)


def align_documents(docs: DataFrame, path_a: str, path_b: str, *, id_col: str, text_col: str) -> DataFrame:
    """Per row of ``docs``: ``row`` (a number of its own), id, counts, digest, and its distinct id pairs with how often each is linked."""
    schema = T.StructType(
        [T.StructField("row", T.LongType()), T.StructField(id_col, docs.schema[id_col].dataType)]
        + [T.StructField(c, T.LongType()) for c in ("n_a", "n_b", "n_groups", "n_links")]
        + [T.StructField("groups_sha256", T.StringType())]
        + [T.StructField(c, T.ArrayType(T.LongType())) for c in ("pairs", "times")]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = load_aligner(path_a, path_b)
        row = TaskContext.get().partitionId() << 40
        for batch in batches:
            at = 0
            for texts in chunks([t or "" for t in batch.column("text").to_pylist()], CHUNK_CHARS):
                found = aligner(texts)
                rows = pa.array(np.arange(row, row + len(texts)))
                yield pa.RecordBatch.from_arrays([rows, batch.column("id").slice(at, len(texts)), *found.values()], schema.names)
                at, row = at + len(texts), row + len(texts)

    return docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(run, schema)


def pair_counts(aligned: DataFrame, width: int) -> DataFrame:
    """``pair``, its ``links`` in the whole corpus, and whether no id of A has more of them with the same id of B (``best``)."""

    def merged(parts: list[pa.Table]) -> pa.Table:
        table = pa.concat_tables(parts).group_by("pair", use_threads=False).aggregate([("links", "sum")])
        return pa.table({"pair": table["pair"], "links": table["links_sum"]})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts: list[pa.Table] = []
        for batch in batches:
            flat = [pc.list_flatten(batch.column(c)) for c in ("pairs", "times")]
            parts.append(merged([pa.table(flat, ["pair", "links"])]))
            if sum(map(len, parts)) > MERGE_ROWS:
                parts = [merged(parts)]
        if parts:
            yield from merged(parts).to_batches()

    counts = aligned.select("pairs", "times").mapInArrow(run, "pair long, links long").groupBy("pair").agg(F.sum("links").alias("links"))
    counts = staged(counts.withColumn("b", F.col("pair") % width), "pair-counts")
    most = counts.groupBy("b").agg(F.max("links").alias("most"))
    return counts.join(most, "b").select("pair", "links", (F.col("links") == F.col("most")).alias("best"))


def align_tokenizers(docs: DataFrame, path_a: str, path_b: str, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: id, ``n_a``, ``n_b``, ``n_groups``, ``n_links``, ``n_best``, ``count_sum``, ``groups_sha256``.

    A (a byte-level BPE file) encodes a space and the text, B (a sentencepiece
    model) the text, to which it puts the space itself. Strings of special
    tokens are plain text. Where a token of A and one of B end at the same byte,
    the two are linked and a group of tokens ends. ``n_best`` counts links
    whose id pair is linked as often in the corpus as any with the same id of B,
    ``count_sum`` adds the corpus counts of a document's links. The digest is of
    ``a1,a2|b1;a3|b2,b3``.

    Texts that are null or empty, or that the tokens of A or B do not spell, have
    no tokens: zeros, and '' as digest. Null and repeated ids and repeated rows
    keep a row each and count each; other columns are not read; an empty table
    gives an empty one. Encoded once: what the counts are given back to is
    written with each document's distinct pairs.
    """
    aligned = staged(align_documents(docs, path_a, path_b, id_col=id_col, text_col=text_col), "aligned")
    counts = pair_counts(aligned, len(PieceTokens(path_b).pieces))
    links = aligned.select("row", F.explode(F.arrays_zip("pairs", "times")).alias("p"))
    # at most as many rows as the vocabularies have bytes: see above
    links = links.select("row", F.col("p.pairs").alias("pair"), F.col("p.times").alias("times")).join(F.broadcast(counts), "pair")
    sums = links.groupBy(F.col("row").alias("of")).agg(
        F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("n_best"), F.sum(F.col("times") * F.col("links")).alias("count_sum")
    )
    rows = aligned.drop("pairs", "times")
    zero = lambda c: F.coalesce(c, F.lit(0)).cast("long").alias(c)
    return rows.join(sums, rows["row"] == sums["of"], "left").select(
        id_col, "n_a", "n_b", "n_groups", "n_links", zero("n_best"), zero("count_sum"), "groups_sha256"
    )
