"""Token counts by whole-token shortcut.

Offline, every vocabulary string that encodes alone as one token is proven to do
so. A pre-token equal to such a string counts one by a look-up; only the others
go through the merges, once per worker and distinct pre-token.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from tablewright.llm.common import documents, id_and_text, slices
from tablewright.llm.tokens import TokenCounts, proven_whole, public_path
from tablewright.session import map_arrow

LIMIT = 1024


def token_counts(docs: DataFrame, tokenizer: str, limit: int = LIMIT, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, n_bytes, n_tokens, over_limit (n_tokens > limit).

    ``tokenizer``: path of a byte-level BPE file of the tokenizers library, the
    same on every machine. A null or empty text has 0 bytes and 0 tokens; a null
    id stays null; repeated rows are counted each; an empty table gives no rows.
    Map only: no shuffle, whatever the lengths of the texts.
    """
    whole = proven_whole(tokenizer)  # bounded by the vocabulary

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = TokenCounts(tokenizer, whole)
        for batch in batches:
            for part in slices(batch, "text"):
                n = [counts.count(t) for t in part.column("text").to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.compute.cast(pa.compute.binary_length(part.column("text")), pa.int64()), pa.array(n, pa.int64())],
                    ["doc_id", "n_bytes", "n_tokens"],
                )

    got = map_arrow(id_and_text(docs, id_col, text_col), count, "doc_id long, n_bytes long, n_tokens long")
    return got.withColumn("over_limit", F.col("n_tokens") > limit)


def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(documents(spark, sf_dir), public_path("byte_bpe_50k.json"))


QUERIES = {"op3_token_counts": op3_token_counts}
