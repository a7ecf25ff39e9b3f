"""Documents to numbered chunks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from formweave.functions.chunks import semantic_chunks, sentence_windows, token_windows
from formweave.functions.text import paragraphs, words
from formweave.operators.positions import global_position


def document_chunks(text: Column, max_len: int = 1000, separator: str | None = None, **rules) -> Column:
    """Chunks of a whole document; none crosses a paragraph border."""
    return F.flatten(
        F.transform(paragraphs(text, separator), lambda p: semantic_chunks(p, max_len, **rules))
    )


def chunks_per_document(docs: DataFrame, chunks: Column, key: Sequence[str], item: str = "text") -> DataFrame:
    """One row per chunk with its 1-based place in the document (W2). No shuffle."""
    return docs.select(*key, F.posexplode(chunks).alias("__i", item)).select(
        *key, (F.col("__i") + 1).alias("id"), item
    )


def numbered_chunks(
    docs: DataFrame, chunks: Column, key: Sequence[str], name: str = "id", item: str = "text"
) -> DataFrame:
    """One row per chunk, numbered 1..N over all documents in key order.

    Documents are range-partitioned by key, so each task numbers a stretch of
    documents; no task sees all chunks.
    """
    def cut(sorted_docs: DataFrame) -> DataFrame:
        return sorted_docs.select(*key, F.explode(chunks).alias(item))

    return global_position(docs, key, name, narrow=cut)


def slice_documents(
    docs: DataFrame, source: Column, chunks: Column, max_len: int
) -> DataFrame:
    """The nested form: one row per source holding its numbered slices (A3, A10, K4).

    Built inside the row: chunks of a document are never spread and regrouped.
    """
    with_chunks = docs.select(source.alias("source"), chunks.alias("__chunks"))
    return with_chunks.select(
        "source",
        F.lit(max_len).alias("max_slice_length"),
        F.size("__chunks").alias("slice_count"),
        F.transform(
            "__chunks", lambda c, i: F.struct((i + 1).alias("id"), c.alias("text"))
        ).alias("slices"),
    )


def retrieval_nodes(
    docs: DataFrame, key: str, tokenizer=words, size: int = 512, overlap: int = 50
) -> DataFrame:
    """(key, id, text) windows for retrieval (R1, W7); a short document stays one node."""
    tokens = docs.select(key, tokenizer(F.col("text")).alias("__t"))
    windows = F.transform(token_windows(F.col("__t"), size, overlap), lambda w: F.array_join(w, " "))
    return chunks_per_document(tokens, windows, [key])


def sentence_nodes(docs: DataFrame, key: str, size: int = 512, overlap: int = 50) -> DataFrame:
    """(key, id, text) windows of whole sentences for retrieval (R1); the text stays as written."""
    return chunks_per_document(docs, sentence_windows(F.col("text"), size, overlap), [key])
