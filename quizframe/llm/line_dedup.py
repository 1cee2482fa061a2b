"""Line deduplication over overlapping three-line windows, in DataFrame functions only.

A window is three consecutive lines of a text (cut at line feeds; a line of spaces
counts as empty), where the begin and the end of the text count as a line each, so texts
of one or two lines have windows too; a window of empty lines is none. A window that occurs more than once
in the corpus stays where it occurs first: in the document with the smallest id, at its
first place there. All its other occurrences go: their positions are merged into
intervals of covered lines, and the text is put together from the lines between them.
Every removed line stays at an earlier place.

Windows are named by 96 bits of hash. Counting is one grouped pass with map-side
combining; only the names travel, and a window repeated a million times costs no more
than one row per task. Texts are joined once with the places to cut, by id.

Rows that share an id count as one document. A NULL id comes after all others. NULL
stays NULL; a text may become empty. What repeats in fewer than three whole lines, begin and
end included, stays: a shared passage inside longer lines, or two lines amid others.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quizframe.runtime import written

WINDOW = 3
#: What stands for an empty line, and for the begin and the end of a text.
EMPTY, BEGIN, END = 0, 1, 2


def lines_of(text: str | Column) -> Column:
    return F.split(text, "\n", -1)


def windows(docs: DataFrame, key: str, text: str) -> DataFrame:
    """``(id, row, pos, a, b)``: the windows of every text and their hashes; the begin of the text is line -1, ``pos`` 0."""

    def mark(value: int) -> Column:
        return F.array(F.lit(value).cast("long"))

    lines = F.transform(
        lines_of(text), lambda x: F.when(F.trim(x) == "", F.lit(EMPTY).cast("long")).otherwise(F.xxhash64(x))
    )
    hashed = docs.select(
        F.col(key).alias("id"), F.xxhash64(text).alias("row"), F.concat(mark(BEGIN), lines, mark(END)).alias("h")
    )
    places = hashed.filter(F.size("h") >= WINDOW).select(
        "id", "row", "h", F.explode(F.sequence(F.lit(0), F.size("h") - WINDOW)).alias("pos")
    )
    three = [F.col("h")[F.col("pos") + i] for i in range(WINDOW)]
    blank = [x.isin(EMPTY, BEGIN, END) for x in three]
    return (
        places.filter(~(blank[0] & blank[1] & blank[2]))
        .select("id", "row", "pos", F.xxhash64(*three).alias("a"), F.hash(*three).alias("b"))
    )


def cuts(docs: DataFrame, key: str, text: str) -> DataFrame:
    """``(id, row, starts)``: ascending first lines of the windows to remove, per document that has some."""
    found = windows(docs, key, text)
    repeated = found.groupBy("a", "b").agg(F.count("*").alias("n"), F.min("id").alias("first")).filter("n > 1").drop("n")
    marked = found.join(repeated.hint("merge"), ["a", "b"]).select(
        "id", "row", F.struct("a", "b", "pos", F.expr("id <=> first").alias("stays")).alias("w")
    )
    grouped = marked.groupBy("id", "row").agg(F.sort_array(F.collect_set("w")).alias("w"))
    # In the first document, the first of each name stays.
    later = F.filter(
        "w",
        lambda x, i: ~x["stays"]
        | F.coalesce((F.get("w", i - 1)["a"] == x["a"]) & (F.get("w", i - 1)["b"] == x["b"]), F.lit(False)),
    )
    return grouped.select(
        "id", "row", F.array_distinct(F.sort_array(F.transform(later, lambda x: x["pos"]))).alias("starts")
    ).filter(F.size("starts") > 0)


def dedup_lines(docs: DataFrame, key: str = "doc_id", text: str = "text", removed: str = "n_removed") -> DataFrame:
    """``docs`` with ``text`` cut and the number of removed lines; a column of that name is replaced."""
    columns = [c for c in docs.columns if c != removed]
    # Columns of docs may have any names, so they travel in a struct.
    whole = docs.select(F.struct(*columns).alias("doc"), F.col(key).alias("id"), F.xxhash64(text).alias("row"))
    cut = cuts(docs, key, text).toDF("cut_id", "cut_row", "starts").hint("merge")
    joined = whole.join(cut, F.expr("id <=> cut_id and row = cut_row"), "left").select("doc", "starts")
    # Intervals of covered lines: windows that overlap or touch are one.
    begins = F.filter("starts", lambda p, i: F.coalesce(p > F.get("starts", i - 1) + WINDOW, F.lit(True)))
    ends = F.transform(
        F.filter("starts", lambda p, i: F.coalesce(p < F.get("starts", i + 1) - WINDOW, F.lit(True))),
        lambda p: p + WINDOW,
    )
    # From places that count the begin as a line to the text's own lines.
    lines = lines_of(F.col("doc")[text])
    parted = joined.select(
        "doc",
        "starts",
        F.transform(begins, lambda p: F.greatest(p - 1, F.lit(0))).alias("begins"),
        F.transform(ends, lambda p: F.least(p - 1, F.size(lines))).alias("ends"),
        lines.alias("lines"),
    )
    kept = F.flatten(
        F.zip_with(
            F.concat(F.array(F.lit(0)), "ends"),
            F.concat("begins", F.array(F.size("lines"))),
            lambda a, b: F.slice("lines", a + 1, b - a),
        )
    )
    shown = parted.select(
        "doc",
        F.when(F.col("starts").isNull(), F.col("doc")[text]).otherwise(F.array_join(kept, "\n")).alias("shorter"),
        F.coalesce(
            F.aggregate(F.zip_with("begins", "ends", lambda a, b: b - a), F.lit(0), lambda s, x: s + x), F.lit(0)
        )
        .cast("long")
        .alias("gone"),
    )
    return shown.select(
        *[(F.col("shorter") if c == text else F.col("doc")[c]).alias(c) for c in columns], F.col("gone").alias(removed)
    )


#: The same result in SQL over ``documents``.
SQL = """
WITH docs AS (SELECT DISTINCT doc_id, text FROM documents),
lines AS (
  SELECT doc_id, text, string_split(text, chr(10)) AS ls FROM docs),
padded AS (
  SELECT doc_id, text, len(ls) AS n, list_concat([chr(10) || 'begin'], ls, [chr(10) || 'end']) AS ps
  FROM lines WHERE ls IS NOT NULL),
places AS (
  SELECT doc_id, text, n, i - 2 AS pos,
         [CASE WHEN trim(x, ' ') = '' THEN '' ELSE x END FOR x IN ps[i:i + 2]] AS w
  FROM (SELECT doc_id, text, n, ps, unnest(range(1, n + 1)) AS i FROM padded)),
named AS (
  SELECT doc_id, text, n, pos, w FROM places
  WHERE len([x FOR x IN w IF x <> '' AND NOT starts_with(x, chr(10))]) > 0),
repeated AS (SELECT w, min(doc_id) AS first FROM named GROUP BY w HAVING count(*) > 1),
marked AS (
  SELECT n.doc_id, n.text, n.n, n.pos,
         row_number() OVER (PARTITION BY n.doc_id, n.text, n.w ORDER BY n.pos) AS k,
         n.doc_id IS NOT DISTINCT FROM r.first AS stays
  FROM named n JOIN repeated r ON n.w = r.w),
covered AS (
  SELECT DISTINCT doc_id, text, pos + d AS line
  FROM marked, (SELECT unnest([0, 1, 2]) AS d)
  WHERE (NOT stays OR k > 1) AND pos + d >= 0 AND pos + d < n),
gone AS (SELECT doc_id, text, list(line) AS line FROM covered GROUP BY doc_id, text)
SELECT d.doc_id AS doc_id,
       CASE WHEN g.line IS NULL THEN d.text
            ELSE array_to_string([x FOR x, i IN string_split(d.text, chr(10)) IF NOT list_contains(g.line, i - 1)], chr(10))
       END AS text,
       coalesce(len(g.line), 0) AS n_removed
FROM documents d LEFT JOIN gone g ON d.doc_id IS NOT DISTINCT FROM g.doc_id AND d.text = g.text
"""
