"""Token counts of whole texts (operator 7)."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loanlake.llm.common import by_bytes, map_batches, pick, table
from loanlake.llm.tokens import encoder, text_list, tokenizer_path

TOKENIZER = "byte_bpe_50k.json"
MAX_TOKENS = 512
#: Bytes of text that are encoded at a time.
BATCH_BYTES = 1 << 17


def count_tokens(
    docs: DataFrame, id: str = "doc_id", text: str = "text", tokenizer: str = TOKENIZER
) -> DataFrame:
    """``doc_id``, ``n_bytes`` and ``n_tokens`` of every row of ``docs``.

    The Arrow function returns lengths only, so no ids travel back to the JVM. It
    encodes batches of equal bytes, across the batches that Arrow brings, and cuts
    long texts at safe boundaries; a text without any is encoded whole, and takes
    memory in proportion to its length. There is no shuffle. A null or empty text has 0 bytes and 0 tokens, a null id stays
    null, a repeated row is counted again, an empty table gives no rows, and other
    columns are not read.
    """
    rows = pick(docs, doc_id=id, text=text).withColumn("text", F.coalesce("text", F.lit("")))
    kind = rows.schema["doc_id"].dataType.simpleString()

    def lengths(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces_of = encoder(tokenizer_path(tokenizer), len)
        for batch in by_bytes(batches, "text", BATCH_BYTES):
            totals = [0] * batch.num_rows
            for number, kept in pieces_of.encode(text_list(batch.column("text"))):
                totals[number] += sum(kept)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("n_bytes"), pa.array(totals, pa.int64())],
                names=["doc_id", "n_bytes", "n_tokens"],
            )

    sized = rows.withColumn("n_bytes", F.octet_length("text").cast("long"))
    return map_batches(sized, lengths, f"doc_id {kind}, n_bytes long, n_tokens long")


def op7_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    counted = count_tokens(table(spark, folder, "documents"))
    return counted.withColumn("over_limit", F.col("n_tokens") > MAX_TOKENS)
