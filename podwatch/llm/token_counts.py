"""Token counts of whole texts, without their ids."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from podwatch.llm.tokens import count_pieces, word_pieces

LIMIT = 2048
BLOCK_BYTES = 1 << 20
LONG_TEXT = 256 << 10


def _parts(text: str) -> Iterator[str]:
    """The text in parts of about LONG_TEXT characters, cut at ASCII white space only."""
    start = 0
    while len(text) - start > LONG_TEXT:
        end = start + LONG_TEXT
        while end < len(text) and text[end] not in " \t\n\x0b\x0c\r":
            end += 1
        yield text[start:end]
        start = end
    yield text[start:]


def token_counts(docs: DataFrame, tokenizer_path: str, limit: int = LIMIT) -> DataFrame:
    """``docs`` without text, with n_bytes, n_tokens and over_limit; clashing columns are replaced.

    ``tokenizer_path`` is the file of a tokenizer that drops white space, readable on every executor. A NULL
    or empty text has 0 bytes and 0 tokens. Special strings in a text count as the library has them by
    default. Texts are encoded in blocks of about BLOCK_BYTES; only counts leave the worker.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = count_pieces(tokenizer_path)
        for batch in batches:
            sizes, counts = [], []
            block: list[tuple[int, list[bytes]]] = []
            held = 0

            def flush() -> None:
                values, at = pieces.of([p for _, part in block for p in part]), 0
                for row, part in block:
                    counts[row] += sum(values[at : at + len(part)])
                    at += len(part)
                block.clear()

            for row, value in enumerate(batch.column("text")):
                text = value.as_py() or ""
                sizes.append(len(text.encode()))
                counts.append(0)
                for part in _parts(text):
                    block.append((row, word_pieces(part)))
                    held += len(part)
                    if held >= BLOCK_BYTES:
                        flush()
                        held = 0
            flush()
            out = batch.drop_columns(["text"])
            out = out.append_column("n_bytes", pa.array(sizes, pa.int64()))
            yield out.append_column("n_tokens", pa.array(counts, pa.int64()))

    docs = docs.drop("n_bytes", "n_tokens", "over_limit")
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema if f.name != "text")
    counted = docs.mapInArrow(count, f"{schema}, n_bytes long, n_tokens long")
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)
