"""Removal of repeated passages: overlapping windows of three lines, in DataFrame operations only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Consecutive lines of a window.
WINDOW = 3
#: What is cut from both ends of a line before it is compared.
EDGES = " \t\r"

_ID, _LINES, _WHICH, _COVERED = "__id", "__lines", "__which", "__covered"


def _solid(lines: Column) -> Column:
    """Numbers and trimmed texts of the lines that have more than white space, in order."""
    numbered = F.transform(lines, lambda line, i: F.struct(i.alias("at"), F.btrim(line, F.lit(EDGES)).alias("line")))
    return F.filter(numbered, lambda x: x["line"] != "")


def _hashes(solid: Column) -> Column:
    """One struct per window: its number, the numbers of its lines, and 128 bits of hash of them."""

    def window(k: Column) -> Column:
        own = [F.get(solid, k + j) for j in range(WINDOW)]
        lines = [x["line"] for x in own]
        both = F.xxhash64(*lines).alias("h1"), F.xxhash64(F.lit(WINDOW), *lines[::-1]).alias("h2")
        return F.struct(k.alias("at"), F.array(*[x["at"] for x in own]).alias("covers"), *both)

    starts = F.when(F.size(solid) >= WINDOW, F.sequence(F.lit(0), F.size(solid) - WINDOW)).otherwise(F.array().cast("array<int>"))
    return F.transform(starts, window)


def repeated_windows(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``id``, ``which`` (a hash of the text) and ``covers`` (line numbers) of every window that occurred before.

    Of equal windows the first is that of the smallest id (null first), then the smallest hash of the text, then
    the earliest in the text. A minimum per window, pre-aggregated, finds it; the join back has one row per
    repeated window on its other side, so a window that many documents share can be split among tasks.
    """
    # The lines are a column of their own: inside the window's lambda they would be split again for every window.
    cut = docs.select(
        F.col(doc_id).alias("id"), F.xxhash64(text).alias("which"), _solid(F.split(F.coalesce(F.col(text), F.lit("")), "\n")).alias("solid")
    )
    windows = cut.select("id", "which", F.inline(_hashes(F.col("solid"))))
    own = F.struct("id", "which", "at")
    repeated = windows.groupBy("h1", "h2").agg(F.min(own).alias("first"), F.max(own).alias("last")).filter(~F.col("first").eqNullSafe(F.col("last")))
    later = windows.join(repeated.select("h1", "h2", "first"), ["h1", "h2"])
    return later.filter(~own.eqNullSafe(F.col("first"))).select("id", "which", "covers")


def drop_repeats(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", count: str | None = None) -> DataFrame:
    """The same rows and columns, with lines removed that a later occurrence of a window covers.

    A line counts without white space at its ends; blank lines are not part of windows and stay. Where
    occurrences overlap, the lines any of them covers go, once. Documents of fewer than three solid lines have no
    window and stay whole. A null text stays null. Rows with the same id and text are one document: none of
    them is a repeat of another, and all come out alike. Documents share nothing with themselves but later
    windows of their own text. Extra columns pass through, whatever their names (names that begin with two
    underscores and ``id``, ``lines``, ``which`` or ``covered`` are reserved). An empty table stays empty.
    ``count`` names a further column, if given: the number of lines removed.
    """
    repeats = repeated_windows(docs, doc_id, text)
    covered = (
        repeats.groupBy("id", "which")
        .agg(F.flatten(F.collect_set("covers")).alias(_COVERED))
        .select(F.col("id").alias(_ID), F.col("which").alias(_WHICH), _COVERED)
    )
    marked = docs.join(covered, docs[doc_id].eqNullSafe(F.col(_ID)) & (F.xxhash64(docs[text]) == F.col(_WHICH)), "left")
    lines = F.col(_LINES)
    kept = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), F.col(_COVERED))
    rest = F.array_join(F.transform(kept, lambda i: F.get(lines, i)), "\n")
    done = marked.withColumn(_LINES, F.split(F.col(text), "\n")).withColumn(text, F.when(F.col(_COVERED).isNull(), F.col(text)).otherwise(rest))
    removed = F.when(F.col(_COVERED).isNull(), 0).otherwise(F.size(F.array_distinct(_COVERED))).cast("long")
    return done.select(*[F.col(f"`{c}`") for c in docs.columns], *([removed.alias(count)] if count else []))


#: The same in DuckDB's SQL: each document and its lines that are left.
ORACLE = f"""
WITH lines AS (
  SELECT doc_id, i - 1 AS i, string_split(text, chr(10))[i] AS line,
         trim(string_split(text, chr(10))[i], ' ' || chr(9) || chr(13)) AS solid
  FROM documents, unnest(range(1, len(string_split(text, chr(10))) + 1)) AS t(i)
), numbered AS (
  SELECT doc_id, i, solid, row_number() OVER (PARTITION BY doc_id ORDER BY i) AS k FROM lines WHERE solid <> ''
), windows AS (
  SELECT * FROM (
    SELECT doc_id, k, solid AS a, lead(solid, 1) OVER w AS b, lead(solid, 2) OVER w AS c FROM numbered
    WINDOW w AS (PARTITION BY doc_id ORDER BY k)
  ) WHERE c IS NOT NULL
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY a, b, c ORDER BY doc_id, k) AS place FROM windows
), covered AS (
  SELECT DISTINCT n.doc_id, n.i FROM ranked r JOIN numbered n ON n.doc_id = r.doc_id AND n.k BETWEEN r.k AND r.k + {WINDOW - 1}
  WHERE r.place > 1
), kept AS (
  SELECT l.doc_id, string_agg(l.line, chr(10) ORDER BY l.i) AS text
  FROM lines l LEFT JOIN covered c ON c.doc_id = l.doc_id AND c.i = l.i WHERE c.i IS NULL GROUP BY l.doc_id
), removed AS (SELECT doc_id, count(*) AS n_removed FROM covered GROUP BY doc_id)
SELECT d.doc_id, CASE WHEN d.text IS NULL THEN NULL ELSE coalesce(k.text, '') END AS text, coalesce(r.n_removed, 0) AS n_removed
FROM documents d LEFT JOIN kept k ON k.doc_id = d.doc_id LEFT JOIN removed r ON r.doc_id = d.doc_id
"""
