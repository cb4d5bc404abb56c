"""Line de-duplication over overlapping three-line windows.

Each document's consecutive lines give overlapping windows.  A window's first occurrence
(smallest id, then earliest line) stays; a later one marks its lines, and the marks of
overlapping windows merge into the removed positions.  Only (hash, id, position) rows
travel; a window that half the documents hold is one partial result per task in the
aggregate, and the join back to it is one that adaptive execution splits.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import documents

WINDOW_LINES = 3


def windows(docs: DataFrame, size: int = WINDOW_LINES) -> DataFrame:
    """(doc_id, at, window): the MD5 of each run of `size` lines, as 16 bytes."""
    lines = docs.select("doc_id", F.split("text", "\n", -1).alias("lines"))
    starts = F.sequence(F.lit(1), F.size("lines") - size + 1)
    at = lines.filter(F.size("lines") >= size).select("doc_id", "lines", F.explode(starts).alias("at"))
    joined = F.array_join(F.slice("lines", F.col("at"), size), "\n")
    return at.select("doc_id", "at", F.unhex(F.md5(joined.cast("binary"))).alias("window"))


def repeated_windows(docs: DataFrame, size: int = WINDOW_LINES) -> DataFrame:
    """(doc_id, at) of every window that also starts earlier."""
    rows = windows(docs, size)
    first = (rows.groupBy("window")
             .agg(F.min(F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "at")).alias("first"),
                  F.count("*").alias("n"))
             .filter("n > 1"))
    here = F.struct(F.col("doc_id").isNull(), "doc_id", "at")
    return (rows.join(first, "window").filter(here > F.col("first"))
            .select("doc_id", "at"))


def line_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
               size: int = WINDOW_LINES) -> DataFrame:
    """One row per document: doc_id, text (lines that stay), n_lines, n_removed, n_spans.

    Lines end at "\\n"; an empty or null text is one empty line.  A document shorter than
    the window holds none and stays whole.  Windows are judged on the input, not on what
    is left.  Rows with one id count as one document's copies: each keeps what starts at
    the same line in the other, so repeated rows stay alike.  Null ids come last.
    """
    rows = documents(docs, id_col, text_col)
    marks = (repeated_windows(rows, size).groupBy("doc_id")
             .agg(F.collect_set("at").alias("starts")))
    marked = rows.join(marks.withColumnRenamed("doc_id", "_id"),
                       F.col("doc_id").eqNullSafe(F.col("_id")), "left")
    lines = F.split("text", "\n", -1)
    covered = F.array_distinct(F.flatten(F.transform(
        F.col("starts"), lambda s: F.sequence(s, s + size - 1))))
    shaped = marked.select("doc_id", "text", lines.alias("lines"), covered.alias("covered"))
    holes = F.coalesce(F.array_sort("covered"), F.array().cast("array<int>"))
    # a mark per line, by position: one pass instead of a search in the list per line
    flags = F.map_from_entries(F.transform(holes, lambda i: F.struct(i, F.lit(True))))
    shaped = shaped.select("doc_id", "lines", holes.alias("holes"), flags.alias("flags"))
    left = F.filter(F.arrays_zip("lines", F.sequence(F.lit(1), F.size("lines")).alias("i")),
                    lambda x: F.try_element_at("flags", x["i"]).isNull())
    spans = F.aggregate("holes", F.struct(F.lit(-1).alias("end"), F.lit(0).cast("long").alias("n")),
                        lambda acc, i: F.struct(i.alias("end"),
                                                (acc["n"] + (i > acc["end"] + 1).cast("long")).alias("n")),
                        lambda acc: acc["n"])
    return shaped.select(
        "doc_id",
        F.when(F.size("holes") == 0, F.array_join("lines", "\n"))
        .otherwise(F.array_join(F.transform(left, lambda x: x["lines"]), "\n")).alias("text"),
        F.size("lines").cast("long").alias("n_lines"),
        F.size("holes").cast("long").alias("n_removed"), spans.alias("n_spans"))
