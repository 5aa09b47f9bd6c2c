"""Token counts by batch encoding in Arrow functions that return lengths only.

A batch is cut into slices of about ``SLICE_BYTES`` bytes (so work is even whatever the lengths of
the texts), texts are split at safe boundaries (before white space), and the library encodes the
distinct pieces of a slice in one call. Ids never leave the task.

Defined cases: null text is the empty text with no tokens; special strings inside a text
are handled as the library does by default; no text is cut short.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martlake.llm.columns import id_text, slices, with_fields
from martlake.llm.pieces import Memo, once, safe_pieces

LIMIT = 512


def _memo(path: str) -> Memo:
    def make():
        from tokenizers import Tokenizer
        t = Tokenizer.from_file(path)
        t.no_truncation()
        t.no_padding()
        return Memo(lambda new: [len(e) for e in t.encode_batch_fast(new, add_special_tokens=False)])
    return once(("count", path), make)


def count_tokens(docs: DataFrame, tokenizer_path: str, limit: int = LIMIT, id_col: str = "doc_id",
                 text_col: str = "text") -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit of every whole text."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo = _memo(tokenizer_path)
        for b in batches:
            for lo, hi in slices(b.column("text")):
                part = b.slice(lo, hi - lo)
                pieces = [safe_pieces(t) for t in part.column("text").to_pylist()]
                length = memo.look_up(pieces)
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pc.cast(pc.binary_length(part.column("text")), pa.int64()),
                     pa.array([sum(map(length, p)) for p in pieces], pa.int64())], ["doc_id", "n_bytes", "n_tokens"])

    own = id_text(docs, id_col, text_col)
    return (own.mapInArrow(run, with_fields(own, "n_bytes long, n_tokens long"))
            .withColumn("over_limit", F.col("n_tokens") > limit))
