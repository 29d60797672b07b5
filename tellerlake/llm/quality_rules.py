"""Quality rules: one table of thresholds, compiled into one projection.

Every measure is a Column over the whole text. The thresholds are bounds of the ratio of
two measures; a rule is compared as `numerator * scale` against `bound * denominator` in
whole numbers, so no rounding decides.

Defined results: a null text counts as an empty one; an empty text has no words, all
measures 0 and fails (too short); rows are judged one by one, so repeated rows give
repeated results and an empty table an empty one; columns that share a name with a
measure are replaced by it. Very long texts cost n log n in their words.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tellerlake.llm.shared import carried, quoted, without_spaces, words

# Frequent function words of English, German, French and Spanish.
STOP_WORDS = (
    "the of and to in a is that it for on was be with as by this at are from or an "
    "der die und das den von zu mit sich des auf ist im dem nicht ein eine als auch "
    "de la le et les des en un une du que est pour qui dans par plus au sur pas "
    "el los las que y en un por con no una su para es al lo como del se"
).split()

SYMBOLS = "#*$%&|<>"
MARKS = "!?"
#: Position bits of a window key; a text has fewer than 2^31 bytes.
_POSITION_BITS = 31


@dataclass(frozen=True)
class Bound:
    """`low <= numerator / denominator <= high`, in hundredths; None: no bound."""

    name: str
    numerator: str
    denominator: str
    low: int | None = None
    high: int | None = None

    def holds(self) -> Column:
        ratio, base = F.col(self.numerator) * 100, F.col(self.denominator)
        checks = F.lit(True)
        if self.low is not None:
            checks = checks & (ratio >= base * self.low)
        if self.high is not None:
            checks = checks & (ratio <= base * self.high)
        return checks


#: At least so many words, and at most this share of them in repeated windows.
MIN_WORDS, MAX_REPEAT = 50, 50

THRESHOLDS = (
    Bound("mean word length", "word_chars", "n_words", low=200, high=1200),
    Bound("symbols for each word", "n_symbols", "n_words", high=10),
    Bound("exclamation and question marks for each word", "n_marks", "n_words", high=30),
    Bound("stop words", "n_stop_words", "n_words", low=2),
    Bound("repeated lines", "n_dup_lines", "n_lines", high=50),
    Bound("lines that end in dots", "n_dotted_lines", "n_lines", high=30),
    Bound("lines that begin with a bullet", "n_bullet_lines", "n_lines", high=90),
)

MEASURES = (
    "n_words", "word_chars", "n_symbols", "n_marks", "n_stop_words", "n_lines",
    "n_dup_lines", "n_dotted_lines", "n_bullet_lines", "n_repeat_words",
)
VERDICTS = ("base_failed", "kept")


def _count_of(text: Column, characters: str) -> Column:
    return (F.length(text) - F.length(F.translate(text, characters, ""))).cast("long")


def _neighbour_equal(items: Column, same) -> Column:
    """Items of a sorted array that equal, by `same`, the item before or after."""
    last = F.size(items) - 1

    def keep(item, i):
        before = F.when(i > 0, same(item, F.get(items, i - 1))).otherwise(False)
        after = F.when(i < last, same(item, F.get(items, i + 1))).otherwise(False)
        return before | after

    return F.filter(items, keep)


def measured(docs: DataFrame, text: str = "text") -> DataFrame:
    """`docs` with the measures of every text.

    Repeated three-word windows are found by sorting window keys inside the row: the key
    holds 33 bits of a hash above the position, so equal windows lie side by side. What
    shares its hash with a neighbour is compared word by word, so hashes only preselect.
    """
    keep = carried(docs, [*MEASURES, *VERDICTS])
    source = F.coalesce(F.col(quoted(text)), F.lit(""))
    base = docs.select(*[F.col(quoted(c)) for c in keep], source.alias("__text"))
    base = base.withColumns({
        "__words": words(F.col("__text")),
        "__lines": F.filter(F.split(F.col("__text"), "\n", -1), lambda x: without_spaces(x) != ""),
    })
    w = F.col("__words")

    def key(i):
        window = F.xxhash64(F.get(w, i), F.get(w, i + 1), F.get(w, i + 2))
        high = F.shiftleft(F.shiftright(window, _POSITION_BITS), _POSITION_BITS)
        return high.bitwiseOR(i.cast("long"))

    starts = F.when(F.size(w) >= 3, F.sequence(F.lit(0), F.size(w) - 3)).otherwise(F.array().cast("array<int>"))
    base = base.withColumn("__keys", F.sort_array(F.transform(starts, key)))
    near = _neighbour_equal(
        F.col("__keys"), lambda a, b: F.shiftright(a, _POSITION_BITS) == F.shiftright(b, _POSITION_BITS)
    )

    def window(k):
        i = k.bitwiseAND(F.lit((1 << _POSITION_BITS) - 1)).cast("int")
        return F.struct(
            F.get(w, i).alias("a"), F.get(w, i + 1).alias("b"), F.get(w, i + 2).alias("c"), i.alias("at")
        )

    base = base.withColumn("__windows", F.sort_array(F.transform(near, window)))
    same = _neighbour_equal(
        F.col("__windows"), lambda p, q: (p["a"] == q["a"]) & (p["b"] == q["b"]) & (p["c"] == q["c"])
    )
    base = base.withColumn("__at", F.sort_array(F.transform(same, lambda x: x["at"])))
    at = F.col("__at")
    # each window adds the words up to the next window, three at most
    covered = F.aggregate(
        F.transform(
            at, lambda x, i: F.least(F.lit(3), F.coalesce(F.get(at, i + 1), x + 3) - x).cast("long")
        ),
        F.lit(0).cast("long"), lambda a, b: a + b,
    )
    t, lines = F.col("__text"), F.col("__lines")

    def size(column):
        return F.size(column).cast("long")

    ends = F.filter(lines, lambda x: F.rtrim(x).endswith("...") | F.rtrim(x).endswith("…"))
    bullets = F.filter(lines, lambda x: F.substring(F.ltrim(x), 1, 1).isin("-", "*", "•", "‣"))
    return base.select(
        *[F.col(quoted(c)) for c in keep],
        size(w).alias("n_words"),
        F.length(without_spaces(t)).cast("long").alias("word_chars"),
        _count_of(t, SYMBOLS).alias("n_symbols"),
        _count_of(t, MARKS).alias("n_marks"),
        size(F.filter(w, lambda x: F.lower(x).isin(STOP_WORDS))).alias("n_stop_words"),
        size(lines).alias("n_lines"),
        (F.size(lines) - F.size(F.array_distinct(lines))).cast("long").alias("n_dup_lines"),
        size(ends).alias("n_dotted_lines"),
        size(bullets).alias("n_bullet_lines"),
        covered.alias("n_repeat_words"),
    )


def judged(docs: DataFrame, text: str = "text", thresholds: tuple[Bound, ...] = THRESHOLDS) -> DataFrame:
    """Measures and verdicts: `base_failed`, and `kept` where every rule holds."""
    base_failed = (F.col("n_words") < MIN_WORDS) | (
        F.col("n_repeat_words") * 100 > F.col("n_words") * MAX_REPEAT
    )
    holds = F.lit(True)
    for bound in thresholds:
        holds = holds & bound.holds()
    with_measures = measured(docs, text)
    return with_measures.withColumns({"base_failed": base_failed, "kept": ~base_failed & holds})


def accepted(docs: DataFrame, text: str = "text") -> DataFrame:
    """The rows of `docs` that pass, with the columns they came with."""
    marked = docs.select(F.struct(*[F.col(quoted(c)) for c in docs.columns]).alias("row"), F.col(quoted(text)).alias("text"))
    # Through a generator, below which no filter can be pushed: a pushed one would hold the
    # measures' expressions many times over.
    verdict = F.explode_outer(F.array(F.struct("row", "kept"))).alias("judged")
    return judged(marked).select(verdict).where("judged.kept").select("judged.row.*")


ORACLE = f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
w AS (SELECT doc_id, t, regexp_extract_all(t, '[^\\x20\\x09-\\x0D]+') AS w FROM d),
p AS (SELECT doc_id, w, unnest(range(1, len(w) - 1)) AS i FROM w),
g AS (SELECT doc_id, i, w[i] AS a, w[i + 1] AS b, w[i + 2] AS c FROM p),
r AS (SELECT doc_id, i FROM (SELECT *, count(*) OVER (PARTITION BY doc_id, a, b, c) AS n FROM g) WHERE n > 1),
cov AS (SELECT doc_id, count(DISTINCT j) AS n FROM (SELECT doc_id, unnest([i, i + 1, i + 2]) AS j FROM r) GROUP BY 1),
l AS (SELECT doc_id, t, w, list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS l FROM w),
m AS (
  SELECT l.doc_id, len(w)::BIGINT AS n_words,
    length(regexp_replace(t, '[\\x20\\x09-\\x0D]', '', 'g'))::BIGINT AS word_chars,
    (length(t) - length(translate(t, '{SYMBOLS}', '')))::BIGINT AS n_symbols,
    (length(t) - length(translate(t, '{MARKS}', '')))::BIGINT AS n_marks,
    len(list_filter(w, lambda x: lower(x) IN ({", ".join(repr(s) for s in dict.fromkeys(STOP_WORDS))})))::BIGINT AS n_stop_words,
    len(l)::BIGINT AS n_lines,
    (len(l) - len(list_distinct(l)))::BIGINT AS n_dup_lines,
    len(list_filter(l, lambda x: rtrim(x, ' ') LIKE '%...' OR rtrim(x, ' ') LIKE '%…'))::BIGINT AS n_dotted_lines,
    len(list_filter(l, lambda x: substr(ltrim(x, ' '), 1, 1) IN ('-', '*', '•', '‣')))::BIGINT AS n_bullet_lines,
    coalesce(cov.n, 0)::BIGINT AS n_repeat_words
  FROM l LEFT JOIN cov ON l.doc_id = cov.doc_id
), v AS (SELECT *, (n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MAX_REPEAT} * n_words) AS base_failed FROM m)
SELECT *, (NOT base_failed AND {" AND ".join(
    " AND ".join([f"100 * {b.numerator} {op} {v} * {b.denominator}" for op, v in ((">=", b.low), ("<=", b.high)) if v is not None])
    for b in THRESHOLDS)}) AS kept
FROM v
"""
