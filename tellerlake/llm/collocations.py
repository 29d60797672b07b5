"""Phrases whose words stand together more often than chance, from one count of windows.

At every word of a text the window of the next words of its piece is laid out in lead
columns, w0 to w4, padded with empty words where the piece ends. Only these longest windows
are counted. `ROLLUP` over the columns then sums the windows that share their first four,
three, two words and one word: the count of a phrase is the sum of the windows that begin
with it, so no shorter n-gram is ever unfolded from the text. The row of a language alone is
the number of its words.

Most windows are of phrases too rare to matter. A first pass counts pairs of neighbours as
64-bit hashes; pairs below the least count end a window, since no phrase that spans them can
reach it. The frequent pairs are sent out as a Bloom filter of at most `MAX_BITS` bits; what
it wrongly lets through makes windows longer, never a count wrong, and a filter that is too
small for a corpus only saves less.

Both passes read texts in slices inside the tasks and combine equal rows there; the rest is
Spark's own aggregation, joins on (language, phrase), which adaptive execution splits where a
part is common, and a ranking whose tasks keep the best rows only.

Defined results: a null text is empty; a null language is `und`; a text without words gives
nothing; rows that repeat count as often as they stand there; scores are floored quotients of
decimals, so they are exact up to 38 digits and an overflow is an error; ties are broken by
count, then phrase; an empty table gives an empty result. Bytes that are no UTF-8 and equal
0xFF end a piece. Only text and language are read, so other columns may have any name.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tellerlake.llm.shared import quoted, written

LONGEST = 5
MIN_COUNT = 100
TOP = 2_000
NO_LANG = "und"
#: A longer phrase drops a shorter one inside it from this share of its count, in percent.
COVERING_PERCENT = 100
#: Bytes of text whose words are held at a time; a longer text is cut between pieces. Windows
#: are combined within such a slice; pairs are combined over several smaller ones.
SLICE_BYTES, PAIR_SLICE_BYTES = 4 << 20, 1 << 20
#: Pairs of words that are combined in a task before they are passed on.
PAIRS_HELD = 1 << 22
#: The filter of frequent pairs has 16 bits for each of them, at most this many (16 MB).
BITS_A_PAIR, MAX_BITS = 16, 1 << 27
_PROBES = np.random.default_rng(13).integers(1 << 62, 1 << 63, size=4, dtype=np.uint64) | np.uint64(1)
_MIX = np.random.default_rng(14).integers(1 << 62, 1 << 63, size=3, dtype=np.uint64) | np.uint64(1)

LEADS = [f"w{k}" for k in range(LONGEST)]

# Fixed values of the contract: a piece ends at one of these characters.
_ENDS = b".,;:!?\n\x0b\x0c\r"
_UPPER = bytes(range(65, 91))
#: A byte that no UTF-8 text has stands for the end of a piece.
_END = b"\xff"
_TABLE = bytes.maketrans(_ENDS + _UPPER, _END * len(_ENDS) + _UPPER.lower())


# --- words of a slice, inside the tasks -------------------------------------------

def _parts(raw: bytes, size: int) -> Iterator[bytes]:
    """A lower-cased text with marked ends of pieces, in parts of about a slice."""
    text, start = raw.translate(_TABLE), 0
    while len(text) - start > size and (cut := text.find(_END, start + size)) >= 0:
        yield text[start:cut]
        start = cut
    yield text[start:]


class Slice:
    """Words of some texts as numbers into their dictionary, -1 at the end of a piece."""

    def __init__(self, parts: list[tuple[bytes, int]]):
        words: list[bytes] = []
        ends = np.empty(len(parts), dtype=np.int64)
        for k, (text, _) in enumerate(parts):
            words += text.replace(_END, b" \xff ").split()
            words.append(_END)
            ends[k] = len(words)
        coded = pa.array(words, type=pa.binary()).dictionary_encode()
        self.words = coded.dictionary
        self.ids = coded.indices.to_numpy().astype(np.int64)
        self.ids[self.ids == self.words.index(_END).as_py()] = -1
        self.langs = np.repeat(np.array([lang for _, lang in parts], dtype=np.int64), np.diff(ends, prepend=0))

    def lead(self, k: int) -> np.ndarray:
        """The word `k` places on, -1 where there is none; ends of pieces are not passed."""
        at = np.full(len(self.ids), -1, dtype=np.int64)
        at[:max(len(self.ids) - k, 0)] = self.ids[k:]
        return at

    def pair_keys(self, lang_hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Whether a pair begins at each place, and the hash of that pair in its language."""
        distinct = np.fromiter(map(xxhash.xxh3_64_intdigest, self.words.to_pylist()), dtype=np.uint64)
        after = self.lead(1)
        pairs = (self.ids >= 0) & (after >= 0)
        keys = distinct[self.ids] * _MIX[0] + distinct[after] * _MIX[1] + lang_hashes[self.langs] * _MIX[2]
        return pairs, keys ^ (keys >> np.uint64(31))


def _slices(batches: Iterator[pa.RecordBatch], lang_names: list[str], most: int) -> Iterator[Slice]:
    """Slices of the texts of a task; `lang_names` gets the languages as they come up."""
    numbers: dict[str, int] = {}
    held: list[tuple[bytes, int]] = []
    size = 0
    for batch in batches:
        for raw, lang in zip(batch.column("text"), batch.column("lang").to_pylist()):
            raw = raw.as_py()
            if not raw:
                continue
            if lang not in numbers:
                numbers[lang] = len(lang_names)
                lang_names.append(lang)
            for part in _parts(raw, most):
                held.append((part, numbers[lang]))
                size += len(part)
                if size >= most:
                    yield Slice(held)
                    held, size = [], 0
    if held:
        yield Slice(held)


def _lang_hashes(names: list[str]) -> np.ndarray:
    return np.array([xxhash.xxh3_64_intdigest(name.encode()) for name in names], dtype=np.uint64)


def _pair_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names: list[str] = []
    held: list[np.ndarray] = []

    def combined() -> pa.RecordBatch:
        keys, n = np.unique(np.concatenate(held), return_counts=True)
        held.clear()
        return pa.record_batch({"key": keys.view(np.int64), "n": n})

    for part in _slices(batches, names, PAIR_SLICE_BYTES):
        pairs, keys = part.pair_keys(_lang_hashes(names))
        held.append(keys[pairs])
        if sum(map(len, held)) >= PAIRS_HELD:
            yield combined()
    if held:
        yield combined()


# --- the filter of frequent pairs -------------------------------------------------

def _probes(keys: np.ndarray, power: int) -> Iterator[np.ndarray]:
    """Bit numbers of each key in a filter of 2^power bits."""
    for factor in _PROBES:
        yield (keys * factor) >> np.uint64(64 - power)


def _bit_rows(power: int):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = batch.column("key").to_numpy().view(np.uint64)
            at = np.unique(np.concatenate(list(_probes(keys, power))))
            word, starts = np.unique(at >> np.uint64(6), return_index=True)
            bit = np.uint64(1) << (at & np.uint64(63))
            bits = np.bitwise_or.reduceat(bit, starts) if len(at) else bit
            yield pa.record_batch({"word": word.view(np.int64), "bits": bits.view(np.int64)})

    return rows


class PairFilter:
    """The bits of the frequent pairs; never more than `max_bits`."""

    def __init__(self, frequent: DataFrame, max_bits: int = MAX_BITS):
        wanted = max(64, frequent.count() * BITS_A_PAIR)
        self.power = min((wanted - 1).bit_length(), max_bits.bit_length() - 1)
        rows = frequent.select("key").mapInArrow(_bit_rows(self.power), "word long, bits long")
        found = rows.groupBy("word").agg(F.bit_or("bits").alias("bits")).toArrow()
        bits = np.zeros(1 << (self.power - 6), dtype=np.uint64)
        bits[found["word"].to_numpy()] = found["bits"].to_numpy().view(np.uint64)
        self.bits = frequent.sparkSession.sparkContext.broadcast(bits)

    def has(self, keys: np.ndarray) -> np.ndarray:
        bits, found = self.bits.value, np.ones(len(keys), dtype=bool)
        for at in _probes(keys, self.power):
            found &= (bits[at >> np.uint64(6)] >> (at & np.uint64(63))) & np.uint64(1) == 1
        return found


# --- windows ----------------------------------------------------------------------

def window_lengths(part: Slice, frequent: np.ndarray) -> np.ndarray:
    """Words of the window at each place: up to five, as long as neighbours are frequent pairs."""
    lengths = (part.ids >= 0).astype(np.int64)
    longer = lengths > 0
    for k in range(1, LONGEST):
        more = np.zeros(len(longer), dtype=bool)
        more[:max(len(more) - k + 1, 0)] = frequent[k - 1:]
        longer &= more
        lengths += longer
    return lengths


def _window_rows(pair_filter: PairFilter):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names: list[str] = []
        for part in _slices(batches, names, SLICE_BYTES):
            pairs, keys = part.pair_keys(_lang_hashes(names))
            pairs[pairs] = pair_filter.has(keys[pairs])
            lengths = window_lengths(part, pairs)
            at = np.flatnonzero(lengths)
            code = part.langs[at]
            # windows get dense numbers, one word more at a time; those that end leave
            for k in range(LONGEST):
                code = code * len(part.words) + part.lead(k)[at]
                _, first, code, n = np.unique(code, return_index=True, return_inverse=True, return_counts=True)
                ends = lengths[at] == k + 1
                ended = np.bincount(code[ends], minlength=len(first))
                shown = at[first[ended > 0]]
                columns = [part.words.take(part.lead(j)[shown]).cast(pa.string()) for j in range(k + 1)]
                columns += [pa.repeat("", len(shown))] * (LONGEST - k - 1)
                lang = pa.array(names, type=pa.string()).take(part.langs[shown])
                yield pa.record_batch([lang, *columns, ended[ended > 0]], names=["lang", *LEADS, "n"])
                at, code = at[~ends], code[~ends]

    return rows


def counted_phrases(
    docs: DataFrame, min_count: int = MIN_COUNT, text: str = "text", lang: str = "lang", max_bits: int = MAX_BITS
) -> DataFrame:
    """lang, size, phrase, f for every phrase of up to five words that reaches `min_count`.

    Size 0 (the empty phrase) is the language itself, with the number of its words.
    """
    rows = docs.select(
        F.col(quoted(text)).cast("binary").alias("text"), F.coalesce(F.col(quoted(lang)), F.lit(NO_LANG)).alias("lang")
    )
    pairs = rows.mapInArrow(_pair_rows, "key long, n long").groupBy("key").agg(F.sum("n").alias("n"))
    frequent = PairFilter(written(pairs.where(F.col("n") >= min_count), "pairs"), max_bits)
    leads = ", ".join(f"{w} string" for w in LEADS)
    windows = rows.mapInArrow(_window_rows(frequent), f"lang string, {leads}, n long")
    longest = windows.groupBy("lang", *LEADS).agg(F.sum("n").alias("n"))
    sums = longest.rollup("lang", *LEADS).agg(F.sum("n").alias("f"), F.grouping_id().alias("rolled"))
    # rolled up columns are null and set one bit each; padding is an empty word
    size = F.lit(LONGEST) - F.bit_count("rolled")
    padded = F.exists(F.array(*LEADS), lambda w: w == "")
    kept = (size == 0) | ((size > 0) & (F.col("f") >= min_count))
    sums = sums.where(kept & ~F.coalesce(padded, F.lit(False)))
    return sums.select("lang", size.alias("size"), F.concat_ws(" ", *LEADS).alias("phrase"), "f")


# --- scores -----------------------------------------------------------------------

def _join_words(start, length):
    return F.array_join(F.slice("words", start, length), " ")


def scored_phrases(counted: DataFrame) -> DataFrame:
    """lang, phrase, size, a, l, r, n, score of every candidate, by its worst cut.

    `counted` is stored by the caller; it is read five times.
    """
    f = counted.where("size > 0").select("lang", "phrase", "f")
    totals = written(counted.where("size = 0").select("lang", F.col("f").alias("n")), "totals")
    candidates = counted.where("size > 1").select("lang", "phrase", "size", F.col("f").alias("a"), F.split("phrase", " ").alias("words"))
    cuts = candidates.select("*", F.explode(F.sequence(F.lit(1), F.col("size") - 1)).alias("k")).select(
        "lang", "phrase", "size", "a", "k",
        _join_words(F.lit(1), F.col("k")).alias("first"), _join_words(F.col("k") + 1, F.col("size") - F.col("k")).alias("rest"),
    )
    cuts = cuts.join(f.select("lang", F.col("phrase").alias("first"), F.col("f").alias("l")), ["lang", "first"])
    cuts = cuts.join(f.select("lang", F.col("phrase").alias("rest"), F.col("f").alias("r")), ["lang", "rest"])
    exact = {c: f"cast({c} as decimal(19, 0))" for c in "anlr"}
    score = F.expr(f"(1000 * {exact['a']} * {exact['n']}) div ({exact['l']} * {exact['r']})")
    worst = F.min_by(F.struct("l", "r", "score"), F.struct("score", "k"))
    best = cuts.join(totals, "lang").withColumn("score", score).groupBy("lang", "phrase").agg(
        F.first("size").alias("size"), F.first("a").alias("a"), F.first("n").alias("n"), worst.alias("cut")
    )
    return best.select("lang", "phrase", "size", "a", "cut.l", "cut.r", "n", "cut.score")


def uncovered(counted: DataFrame, percent: int = COVERING_PERCENT) -> DataFrame:
    """lang, phrase of the candidates that no longer candidate covers."""
    candidates = counted.where("size > 1").select("lang", "phrase", "size", "f")
    inner = candidates.where("size > 2").withColumn("words", F.split("phrase", " ")).select(
        "lang", "words", "size", "f", F.explode(F.sequence(F.lit(2), F.col("size") - 1)).alias("length")
    )
    inner = inner.select("*", F.explode(F.sequence(F.lit(1), F.col("size") - F.col("length") + 1)).alias("start"))
    longer = inner.groupBy("lang", _join_words(F.col("start"), F.col("length")).alias("phrase")).agg(F.max("f").alias("most"))
    met = candidates.join(longer, ["lang", "phrase"], "left")
    return met.where(F.col("most").isNull() | (100 * F.col("most") < percent * F.col("f"))).select("lang", "phrase")


def collocations(
    docs: DataFrame, min_count: int = MIN_COUNT, top: int = TOP, text: str = "text", lang: str = "lang", max_bits: int = MAX_BITS
) -> DataFrame:
    """The best phrases of each language: lang, rank, phrase, a, l, r, n, score."""
    counted = written(counted_phrases(docs, min_count, text, lang, max_bits), "phrases")
    scores = scored_phrases(counted).join(uncovered(counted), ["lang", "phrase"])
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = scores.withColumn("rank", F.row_number().over(order).cast("long")).where(F.col("rank") <= top)
    return ranked.select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def sql(min_count: int = MIN_COUNT, top: int = TOP) -> str:
    """DuckDB's form over `documents`."""
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return rf"""
WITH piece AS (
  SELECT coalesce(lang, '{NO_LANG}') AS lang,
    unnest(regexp_split_to_array(translate(coalesce(text, ''), '{upper}', '{upper.lower()}'), '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents),
line AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM piece),
totals AS (SELECT lang, sum(len(w))::BIGINT AS n FROM line GROUP BY 1 HAVING sum(len(w)) > 0),
place AS (SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM line),
gram AS (SELECT lang, k, array_to_string(w[i:i + k - 1], ' ') AS phrase FROM place, range(1, {LONGEST + 1}) AS s(k) WHERE i + k - 1 <= len(w)),
f AS (SELECT lang, k, phrase, count(*)::BIGINT AS f FROM gram GROUP BY ALL HAVING count(*) >= {min_count}),
cand AS (SELECT lang, k, phrase, f AS a, string_split(phrase, ' ') AS w FROM f WHERE k > 1),
cut AS (SELECT cand.*, c FROM cand, range(1, {LONGEST}) AS s(c) WHERE c < k),
scored AS (
  SELECT cut.lang, cut.phrase, a, c, l.f AS l, r.f AS r, n, ((1000::HUGEINT * a * n) // (l.f::HUGEINT * r.f))::BIGINT AS score
  FROM cut JOIN totals ON cut.lang = totals.lang
  JOIN f l ON l.lang = cut.lang AND l.phrase = array_to_string(w[1:c], ' ')
  JOIN f r ON r.lang = cut.lang AND r.phrase = array_to_string(w[c + 1:], ' ')),
worst AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, c) = 1),
inside AS (
  SELECT lang, a, array_to_string(w[i:i + m - 1], ' ') AS phrase
  FROM cand, range(2, {LONGEST}) AS s(m), range(1, {LONGEST}) AS t(i) WHERE m < k AND i + m - 1 <= k),
covered AS (SELECT lang, phrase, max(a) AS most FROM inside GROUP BY ALL),
kept AS (
  SELECT worst.* FROM worst LEFT JOIN covered USING (lang, phrase)
  WHERE most IS NULL OR 100 * most < {COVERING_PERCENT} * a),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept)
SELECT lang, rank, phrase, a, l, r, n, score FROM ranked WHERE rank <= {top}
"""


ORACLE = sql()
