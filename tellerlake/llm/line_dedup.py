"""Removing passages that occurred before: windows of three consecutive lines.

A document is cut at line feeds. Each run of three lines is hashed (128 bits); a window
that occurs more than once in the corpus is kept where it occurs first, by id and
position, and its three lines are covered at every other place. Covered positions of
overlapping windows are merged and the covered lines go.

Only hashes, ids and positions are shuffled; the first place of a window is a minimum that
combines before the shuffle, and the join back to the places of a frequent window is one
that adaptive execution splits. The texts move once, to meet their covered positions.

Defined results: a null text stays null; a text of one or two lines has no window and stays,
as the SQL of the query states, but with `short` all its lines are its one window, and it
goes if a text of the same lines came before; windows without any word do not count; a null id comes first in order; rows that repeat an
id and its text are one occurrence and get the same result; a text whose lines are all
covered becomes empty, and its row stays; an empty table gives an empty one; all columns
are carried, and derived names replace clashing ones.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tellerlake.llm.shared import carried, quoted, without_spaces

LINES = 3
DERIVED = ["n_lines", "n_removed"]


def _windows(docs: DataFrame, short: bool) -> DataFrame:
    """id, text_hash, span, at, key: one row for each window that has a word."""
    lines = docs.select("id", F.xxhash64("text").alias("text_hash"), F.split("text", "\n", -1).alias("lines"))
    if not short:
        lines = lines.where(F.size("lines") >= LINES)
    hashed = lines.select(
        "id", "text_hash",
        F.transform("lines", lambda x: F.struct(
            F.xxhash64(x).alias("a"), F.xxhash64(F.lit(1), x).alias("b"), (without_spaces(x) != "").alias("has_word")
        )).alias("h"),
        F.size("lines").alias("n"),
    )
    h = F.col("h")

    # lines that a short text does not have are null, and hashes pass over nulls
    def window(i):
        three = [F.get(h, i + k) for k in range(LINES)]
        return F.struct(
            i.alias("at"),
            F.struct(F.xxhash64(*[x["a"] for x in three]).alias("a"), F.xxhash64(*[x["b"] for x in three]).alias("b")).alias("key"),
            (three[0]["has_word"] | three[1]["has_word"] | three[2]["has_word"]).alias("has_word"),
        )

    found = F.filter(F.transform(F.sequence(F.lit(0), F.greatest(F.col("n") - LINES, F.lit(0))), window), lambda x: x["has_word"])
    span = F.least("n", F.lit(LINES)).alias("span")
    return hashed.select("id", "text_hash", span, F.inline(found)).drop("has_word")


def covered(docs: DataFrame, short: bool = False) -> DataFrame:
    """id, text_hash and the covered positions of each document that has any.

    `docs` has id and text.
    """
    windows = _windows(docs, short)
    repeated = (
        windows.groupBy("key")
        .agg(F.min(F.struct("id", "at")).alias("first"), F.max(F.struct("id", "at")).alias("last"))
        .where(~F.col("first").eqNullSafe(F.col("last")))
        .select(F.col("key").alias("r_key"), "first")
    )
    later = windows.join(repeated, F.col("key") == F.col("r_key")).where(
        ~F.struct("id", "at").eqNullSafe(F.col("first"))
    )
    starts = later.groupBy("id", "text_hash").agg(F.collect_set("at").alias("starts"), F.max("span").alias("span"))
    merged = F.array_distinct(F.flatten(F.transform("starts", lambda s: F.sequence(s, s + F.col("span") - 1))))
    return starts.select("id", "text_hash", F.sort_array(merged).alias("at"))


def deduplicated(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", short: bool = False) -> DataFrame:
    """`docs` with later occurrences removed from the text, and the numbers of lines.

    `short`: texts of one or two lines are compared as a whole.
    """
    keep = carried(docs, DERIVED)
    hits = covered(docs.select(F.col(quoted(doc_id)).alias("id"), F.col(quoted(text)).alias("text")).where(F.col("text").isNotNull()), short)
    rows = docs.select(
        F.struct(*[F.col(quoted(c)) for c in keep]).alias("row"),
        F.col(quoted(doc_id)).alias("id"), F.xxhash64(F.col(quoted(text))).alias("text_hash"),
    )
    hits = hits.select(F.col("id").alias("h_id"), F.col("text_hash").alias("h_hash"), "at")
    met = rows.join(hits, rows["id"].eqNullSafe(hits["h_id"]) & (rows["text_hash"] == hits["h_hash"]), "left")
    value = F.col("row")[text]
    met = met.select("row", "at", F.split(value, "\n", -1).alias("lines"))
    # positions are sorted: what stays are the stretches between them
    at = F.col("at")
    bounds = F.concat(F.array(F.lit(-1)), at, F.array(F.size("lines")))
    stretches = F.zip_with(F.slice(bounds, 1, F.size(bounds) - 1), F.slice(bounds, 2, F.size(bounds) - 1),
                           lambda a, b: F.slice(F.col("lines"), a + 2, b - a - 1))
    text_kept = F.when(at.isNull(), value).otherwise(F.array_join(F.flatten(stretches), "\n"))
    columns = [(text_kept if c == text else F.col("row")[c]).alias(c) for c in keep]
    return met.select(
        *columns,
        F.coalesce(F.when(value.isNotNull(), F.size("lines")), F.lit(0)).cast("long").alias("n_lines"),
        F.coalesce(F.size(at), F.lit(0)).cast("long").alias("n_removed"),
    )


def without_repeats(docs: DataFrame) -> DataFrame:
    """`docs` with shortened texts and the columns they came with; short texts are compared too."""
    return deduplicated(docs.select(*[F.col(quoted(c)) for c in docs.columns]), short=True).select(*[F.col(quoted(c)) for c in docs.columns])


_SQL = """
line AS (SELECT doc_id, string_split(text, chr(10)) AS l FROM {docs} WHERE text IS NOT NULL),
place AS (SELECT doc_id, l, unnest(range(1, len(l) - 1)) AS i FROM line),
win AS (SELECT doc_id, i, l[i] AS a, l[i + 1] AS b, l[i + 2] AS c FROM place
        WHERE regexp_matches(l[i] || l[i + 1] || l[i + 2], '[^\\x20\\x09-\\x0D]')),
ranked AS (SELECT doc_id, i, row_number() OVER (PARTITION BY a, b, c ORDER BY doc_id, i) AS k FROM win),
cov AS (SELECT doc_id, list(DISTINCT j) AS js FROM (SELECT doc_id, unnest([i, i + 1, i + 2]) AS j FROM ranked WHERE k > 1) GROUP BY 1),
lines_kept AS (
  SELECT d.doc_id, d.lang, d.source, d.n_chars,
    CASE WHEN js IS NULL THEN d.text ELSE coalesce(array_to_string(list_filter(l, lambda x, i: NOT list_contains(js, i)), chr(10)), '') END AS text,
    coalesce(len(l), 0)::BIGINT AS n_lines, coalesce(len(js), 0)::BIGINT AS n_removed
  FROM {docs} d LEFT JOIN line ON d.doc_id = line.doc_id LEFT JOIN cov ON d.doc_id = cov.doc_id)
"""

#: The same with texts of one or two lines, whose only window is all their lines.
_SHORT_SQL = _SQL.replace("range(1, len(l) - 1)", "range(1, greatest(len(l) - 1, 2))").replace(
    "l[i] || l[i + 1] || l[i + 2], '", "concat(l[i], l[i + 1], l[i + 2]), '"
)

ORACLE = f"WITH {_SQL.format(docs='documents')} SELECT * FROM lines_kept"
