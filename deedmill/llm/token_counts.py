"""Token counts by rank-synchronous merging of ragged arrays; no shuffle at all."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from deedmill.llm.tokenizers import load_units

#: Units that a Python worker remembers; beyond it starts anew.
REMEMBERED = 600_000
#: Characters of text that are held as arrays at once.
CHUNK_CHARS = 4_000_000


def chunks(texts: list[str], chars: int = CHUNK_CHARS) -> Iterator[list[str]]:
    """Consecutive texts of about ``chars`` characters together, at least one."""
    at = 0
    while at < len(texts):
        end, size = at, 0
        while end < len(texts) and (end == at or size + len(texts[end]) <= chars):
            size += len(texts[end])
            end += 1
        yield texts[at:end]
        at = end


def count_tokens(
    docs: DataFrame, path: str, *, id_col: str = "doc_id", text_col: str = "text", limit: int = 1024
) -> DataFrame:
    """One row per row of ``docs``: id, ``n_bytes``, ``n_tokens`` and ``over_limit``.

    Null and empty texts have 0 bytes and 0 tokens; rows with a null id or with
    repeated ids keep a row each; other columns are not read. Texts are counted
    whole. Distinct pre-tokens of a batch are merged as one ragged array (see
    ``Units.merge``), and a text's count is the sum over its pre-tokens. Each
    worker remembers a bounded number of counts, so that common words are merged
    once per worker; results do not depend on it.
    """
    schema = T.StructType(
        [
            T.StructField(id_col, docs.schema[id_col].dataType),
            T.StructField("n_bytes", T.LongType()),
            T.StructField("n_tokens", T.LongType()),
            T.StructField("over_limit", T.BooleanType()),
        ]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        units = load_units(path)
        known: dict[str, int] = {}

        def totals(texts: list[str]) -> list[int]:
            split = [units.split(t) for t in texts]
            new = list(set().union(*split).difference(known))
            if len(known) + len(new) > REMEMBERED:
                known.clear()
                new = list(set().union(*split))
            if new:
                known.update(zip(new, units.merge(new)[1].tolist()))
            return [sum(map(known.__getitem__, s)) for s in split]

        for batch in batches:
            texts = [t or "" for t in batch.column("text").to_pylist()]
            n = np.array([c for part in chunks(texts) for c in totals(part)], np.int64)
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), batch.column("n_bytes"), pa.array(n), pa.array(n > limit)], schema.names
            )

    return docs.select(
        F.col(id_col).alias("id"),
        F.col(text_col).alias("text"),
        F.coalesce(F.octet_length(text_col), F.lit(0)).cast("long").alias("n_bytes"),
    ).mapInArrow(run, schema)
