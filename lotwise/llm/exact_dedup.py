"""Exact dedup: two-pass Bloom filtering, then grouping of the rows that may be repeated."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lotwise.llm.tables import BLANKS, bitmap_size, bitmap_table, checkpointed, look_up, text_or_empty, with_bit

#: Bits per row of the input in each filter; with eight, a unique row passes one filter by chance in one of eight cases.
BITS_PER_ROW = 8
#: Largest filter (512 MB broadcast). Inputs of more than 500 million rows fill it more densely: more unique rows are
#: then shuffled as 50-byte digests, and the result stays the same.
MOST_BITS = 2**32


def digests(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, row, digest) of each row, which has a number of its own."""
    return docs.select(F.monotonically_increasing_id().alias("row"), *_identity(id_col, text_col))


def _identity(id_col: str, text_col: str) -> list[Column]:
    return [F.col(id_col).alias("id"), digest_of(text_col).alias("digest")]


def digest_of(text_col: str) -> Column:
    """SHA-256 of the text after replacing each run of blanks by one space; null counts as empty."""
    return F.unhex(F.sha2(F.regexp_replace(text_or_empty(text_col), BLANKS, " "), 256))


class RepeatFilter:
    """Two hash filters made from digests; rows that fail either are certainly unique.

    The first pass counts the rows in each slot and lets those pass whose slot holds two or more. The second pass
    does so among the survivors with another hash.
    """

    def __init__(self, rows: DataFrame):
        self.bits = bitmap_size(rows.count(), BITS_PER_ROW, MOST_BITS)
        self.maps: list[DataFrame] = []
        for _ in range(2):
            k = len(self.maps)
            twice = self.passing(rows).select(self._slot(k).alias("slot")).groupBy("slot").count().filter("count > 1")
            self.maps.append(checkpointed(bitmap_table(twice, "slot")))

    def _slot(self, k: int):
        return F.pmod(F.xxhash64("digest", F.lit(k)), F.lit(self.bits))

    def flagged(self, rows: DataFrame) -> DataFrame:
        """``rows`` with boolean ``maybe``; no row is shuffled."""
        names = []
        for k, bitmap in enumerate(self.maps):
            names.append(f"pass_{k}")
            rows = with_bit(rows.withColumn("slot", self._slot(k)), "slot", bitmap, names[-1]).drop("slot")
        maybe = F.lit(True)
        for name in names:
            maybe = maybe & F.col(name)
        return rows.withColumn("maybe", maybe).drop(*names)

    def passing(self, rows: DataFrame) -> DataFrame:
        return self.flagged(rows).filter("maybe").drop("maybe") if self.maps else rows


def _groups(candidates: DataFrame) -> DataFrame:
    first = F.min(F.struct(F.col("id").isNull().alias("none"), "id", "row"))
    return candidates.groupBy("digest").agg(first.alias("keep"), F.count("*").alias("n"))


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: id_col, keep_id, group_size, kept, text_sha256.

    Only digests are written and moved, never texts. Rows that pass both filters are grouped by digest; all
    others are unique and go straight to the result.

    Of equal texts the smallest id stays. Rows with the same id and text (repeated rows): one of them stays. A null id
    counts as larger than all others. Null and empty texts are equal. An empty table gives an empty result; other
    columns are neither read nor returned.
    """
    every = checkpointed(digests(docs, id_col, text_col))
    flagged = RepeatFilter(every).flagged(every)
    unique = flagged.filter("not maybe")
    candidates = flagged.filter("maybe").drop("maybe")
    found = look_up(candidates, checkpointed(_groups(candidates)), "digest", "n")
    result = unique.select(
        "id", F.col("id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"), F.lit(True).alias("kept"), "digest"
    ).unionByName(
        found.select(
            "id",
            F.col("keep.id").alias("keep_id"),
            F.col("n").alias("group_size"),
            (F.col("row") == F.col("keep.row")).alias("kept"),
            "digest",
        )
    )
    return result.select(
        F.col("id").alias(id_col), "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256")
    )


def drop_exact_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that ``exact_groups`` keeps, with all their columns, whatever their names.

    Whole rows of unique texts stay where they are; only rows that pass both filters are shuffled.
    """
    every = checkpointed(digests(docs, id_col, text_col))
    filters = RepeatFilter(every)
    stay = _groups(filters.passing(every)).select(F.col("keep.id").alias("id"), "digest")
    named = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc")
    rows = filters.flagged(docs.select(named, *_identity(id_col, text_col)))
    candidates = rows.filter("maybe").alias("c")
    kept = candidates.join(
        stay.alias("s"), F.expr("c.id <=> s.id and c.digest = s.digest"), "left_semi"
    ).dropDuplicates(["id", "digest"])
    return rows.filter("not maybe").unionByName(kept).select("doc.*")
