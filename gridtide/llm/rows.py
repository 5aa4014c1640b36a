"""Rows of a table of texts, told apart whatever their ids are.

Ids may be missing or repeat. A row's ``mark`` is empty where its id stands for one row alone,
else the MD5 of its text (128 bits): rows with equal id and mark are equal in all that matters here.
Marks cost nothing where ids are unique, which one pass over the id column finds out.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from gridtide.staging import stage


def column(df: DataFrame, name: str) -> Column:
    """A column by its exact name, dots included."""
    return df["`" + name.replace("`", "``") + "`"]


def whole_row(df: DataFrame) -> Column:
    """All columns as one struct, so that no name can clash with those an operator adds."""
    return F.struct(*(column(df, name).alias(name) for name in df.columns))


def unpacked(row: str, df: DataFrame) -> list[Column]:
    """The columns of ``df`` out of such a struct."""
    return [F.col(row).getField(name).alias(name) for name in df.columns]


def text_of(df: DataFrame, name: str) -> Column:
    return F.coalesce(column(df, name).cast("string"), F.lit(""))


class TextRows:
    """Texts of a table with what tells its rows apart."""

    def __init__(self, docs: DataFrame, id_column: str, text_column: str):
        self.docs, self.id_column, self.text_column = docs, id_column, text_column
        ids = docs.select(column(docs, id_column).cast("long").alias("often_doc"))
        counted = ids.where("often_doc is not null").groupBy("often_doc").agg(F.count(F.lit(1)).alias("n"))
        often = stage(counted.where("n > 1").select("often_doc"), "repeated-ids")
        self.often = None if often.isEmpty() else often

    def packed(self) -> DataFrame:
        """(row, doc, text, mark): all columns of a row as a struct, its id, text and mark."""
        docs = self.docs
        rows = docs.select(
            whole_row(docs).alias("row"), column(docs, self.id_column).cast("long").alias("doc"),
            text_of(docs, self.text_column).alias("text"),
        )
        unclear = F.col("doc").isNull()
        if self.often is not None:
            rows = rows.join(self.often, F.col("doc") == F.col("often_doc"), "left")
            unclear = unclear | F.col("often_doc").isNotNull()
        digest = F.unhex(F.md5(F.col("text").cast("binary")))
        mark = F.when(unclear, digest).otherwise(F.lit(b""))
        return rows.select("row", "doc", "text", mark.alias("mark"))

    def texts(self) -> DataFrame:
        """(doc, text as bytes, mark)."""
        return self.packed().select("doc", F.col("text").cast("binary").alias("text"), "mark")
