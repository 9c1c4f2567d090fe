"""Token counts by the whole-token shortcut (operator 6).

The vocabulary strings that encode alone as one token are proven once per
worker (``WordBpe.whole``). A pre-token among them counts one without any
merge; only the others are merged, and their counts are kept in a bounded
cache. The counts equal the library's for every text.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import values
from .wordbpe import word_bpe


def token_counts(df: DataFrame, tokenizer: str, limit: int = 2048, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: ``doc_id, n_bytes, n_tokens, over_limit``.

    - null and empty texts count 0 bytes and 0 tokens; a null id stays null;
    - whole texts are counted, whatever their length;
    - repeated rows each give a row; an empty table gives an empty result;
    - other columns are not read, whatever their names.

    No shuffle: counting is a map over the scan.
    """
    rows = df.select(
        F.col(id_col).alias("doc_id"),
        F.coalesce(F.octet_length(F.col(text_col)), F.lit(0)).cast("long").alias("n_bytes"),
        F.col(text_col).alias("text"),
    )

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = word_bpe(tokenizer)
        for batch in batches:
            n = [bpe.count(text) for text in values(batch, "text")]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("n_bytes"), pa.array(n, pa.int64()), pa.array([k > limit for k in n], pa.bool_())],
                names=["doc_id", "n_bytes", "n_tokens", "over_limit"],
            )

    id_type = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(count, f"doc_id {id_type}, n_bytes long, n_tokens long, over_limit boolean")
