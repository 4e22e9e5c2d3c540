"""Exact deduplication by skew-safe combining.

Three steps, each of which groups by the full text beside its SHA-256 digest, so that two texts count as
equal only when their whole contents are:

1. local: the partial aggregation of step 2 leaves one row for each text in each input partition;
2. salted: the salt is the input partition's number modulo `salts`, so the rows of one text go to that many
   reducers at most, and a text that makes up a third of the corpus sends one row from each partition;
3. global: the winners of the salts, at most `salts` rows a text, meet.

What goes back to the documents is the digest with an independent 64-bit hash and the byte length, never the text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Reducers that the rows of one text are spread over before the winners meet.
SALTS = 16


def _content(text: Column) -> list[Column]:
    return [F.sha2(text, 256).alias("_digest"), F.xxhash64(text).alias("_hash"), F.octet_length(text).alias("_bytes")]


def _salted(docs: DataFrame, columns: list[Column], salts: int) -> DataFrame:
    return docs.select(*columns, F.pmod(F.spark_partition_id(), F.lit(salts)).alias("_salt"))


def groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", salts: int = SALTS) -> DataFrame:
    """One row for each distinct text: _digest, _hash, _bytes, keep_id (largest id), group_size."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = _salted(docs, [F.col(id_col).alias("_id"), text.alias("_text"), F.sha2(text, 256).alias("_digest")], salts)
    salted = rows.groupBy("_digest", "_salt", "_text").agg(F.max("_id").alias("_id"), F.count("*").alias("_n"))
    whole = salted.groupBy("_digest", "_text").agg(F.max("_id").alias("keep_id"), F.sum("_n").alias("group_size"))
    return whole.select("_digest", F.xxhash64("_text").alias("_hash"), F.octet_length("_text").alias("_bytes"), "keep_id", "group_size")


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", salts: int = SALTS) -> DataFrame:
    """One row for each input row: the id, keep_id, group_size, kept, text_sha256.

    Null text counts as empty. The largest id of equal texts stays; null ids are smaller than any other and
    stay only where a text has no other. Rows that repeat an id and its text each count in group_size and all say
    kept, as they are the same document. An empty table gives no rows; other columns are ignored, whatever their names.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    mine = docs.select(F.col(id_col).alias("_id"), *_content(text))
    found = groups(docs, id_col, text_col, salts)
    return mine.join(found, ["_digest", "_hash", "_bytes"]).select(
        F.col("_id").alias(id_col),
        "keep_id",
        "group_size",
        F.col("_id").eqNullSafe(F.col("keep_id")).alias("kept"),
        F.col("_digest").alias("text_sha256"),
    )


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", salts: int = SALTS) -> DataFrame:
    """The rows of docs that stay, all their columns: the row with the largest id of each text, one where that repeats.

    The row travels beside its text through the same three steps, so nothing is joined back.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    rank = F.struct(F.col(id_col).isNotNull().alias("known"), F.col(id_col).alias("id"), F.col(text_col).isNotNull().alias("real"))
    rest = [c for c in docs.columns if c != text_col]
    payload = F.struct(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(rest)], F.col(text_col).isNull().alias("void"))
    rows = _salted(docs, [text.alias("_text"), F.sha2(text, 256).alias("_digest"), rank.alias("_rank"), payload.alias("_row")], salts)
    best = [F.max_by("_row", "_rank").alias("_row"), F.max("_rank").alias("_rank")]
    whole = rows.groupBy("_digest", "_salt", "_text").agg(*best).groupBy("_digest", "_text").agg(*best)
    back = {c: F.col(f"_row.c{i}") for i, c in enumerate(rest)}
    back[text_col] = F.when(~F.col("_row.void"), F.col("_text"))
    return whole.select(*[back[c].alias(c) for c in docs.columns])


ORACLE_SQL = """
SELECT doc_id,
       max(doc_id) OVER (PARTITION BY coalesce(text, '')) AS keep_id,
       CAST(count(*) OVER (PARTITION BY coalesce(text, '')) AS BIGINT) AS group_size,
       doc_id = max(doc_id) OVER (PARTITION BY coalesce(text, '')) AS kept,
       sha256(coalesce(text, '')) AS text_sha256
FROM documents
"""
