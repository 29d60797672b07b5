"""Judging urls: rules by host and path, then a Bloom filter cascade over domains.

A rule fits its host and all subdomains if the path starts with the rule's; the longest that
fits decides. For all other urls a list of blocked domains decides: a url is blocked if its
host, or any domain above it, is listed.

The list is a cascade of Bloom filters. The keys are all hosts that occur in the corpus; a
host is a listed key if a listed domain is its own or above it. The first level holds the
listed keys, the second those other keys that the first takes for listed, the third those
listed keys that the second takes for others, and so on until a level makes no mistake. So
the answer is exact for every host of the corpus, and no url is joined with the list. Every
level is a table of one row (an array of 64-bit words) in the shared folder and enters the
projection as a scalar subquery.

Scale: keys are reduced to distinct ones on the map side, so a host with a third of all urls
counts once in a task. A level's words combine by `bit_or` before they are shuffled; only the
finished words, at most `MAX_BITS` / 64 in all levels together, meet in one task. A list that
needs more bits than that is not sent out: then hosts are looked up by a join.

Defined results: a null url, or one without `://`, has an empty host and path, no rule, and
is allowed; an empty host has no keys; domains have at most 253 characters, so of a longer
host only the labels that fit count; repeated rows each get their row; an
empty table gives an empty one; columns are carried and derived names replace clashing ones.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tellerlake.llm.shared import carried, lower_ascii, quoted, written

# Fixed values of the contract: verdict, host and path of each rule.
RULES = (
    ("allow", "org", "/"),
    ("block", "example.org", "/es/"),
    ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
)
#: A domain is listed if one of these is a part, between hyphens, of its first label.
TERMS = (
    "adult", "ads", "adserver", "bet", "bets", "betting", "casino", "gambling", "malware", "phishing",
    "pills", "poker", "porn", "sex", "spam", "tracker", "viagra", "warez", "xxx",
)
LONGEST_DOMAIN = 253
#: Bits of all levels together that are sent to the tasks: 32 MB.
MAX_BITS = 1 << 28
#: Share of the other keys that a level after the first takes for its own: 2 to this power.
LATER_BITS = 4
MOST_HASHES = 30

DERIVED = ["host", "path", "rule", "listed", "verdict"]

_URL = r"(?s)^.*?://([^/?#]*)([^?#]*)"


def host_of(url: Column) -> Column:
    return lower_ascii(F.coalesce(F.regexp_extract(url, _URL, 1), F.lit("")))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, _URL, 2), F.lit(""))


def fitting_rule(host: Column, path: Column, rules: Sequence[tuple[str, str, str]] = RULES) -> Column:
    """The longest rule that fits, as a struct of rule and verdict; null where none does."""
    chosen = F.lit(None)
    for verdict, domain, prefix in sorted(rules, key=lambda r: (len(r[1] + r[2]), r)):
        fits = ((host == domain) | host.endswith("." + domain)) & path.startswith(prefix)
        value = F.struct(F.lit(domain + prefix).alias("rule"), F.lit(verdict).alias("verdict"))
        chosen = F.when(fits, value).otherwise(chosen)
    return chosen.cast("struct<rule:string,verdict:string>")


def domains(host: Column) -> Column:
    """The host and all domains above it, longest first."""
    cut = F.regexp_replace(F.right(host, F.lit(LONGEST_DOMAIN + 1)), r"^[^.]*\.?", "")
    labels = F.split(F.when(F.length(host) > LONGEST_DOMAIN, cut).otherwise(host), r"\.")
    above = F.transform(
        F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), ".")
    )
    return F.filter(above, lambda d: d != "")


def is_listed_name(domain: Column, terms: Sequence[str] = TERMS) -> Column:
    """Whether the first of two or more labels has one of the terms as a part."""
    return domain.rlike(rf"^([^.]*-)?({'|'.join(terms)})(-[^.]*)?\.")


# --- the cascade ------------------------------------------------------------------

@dataclass(frozen=True)
class Level:
    bits: DataFrame  # one row, column `bits`: array<bigint>
    size: int
    hashes: int
    seed: int


def _positions(key: Column, size: int, hashes: int, seed: int) -> list[Column]:
    """Bit numbers of a key, from two halves of one 64-bit hash (no sum leaves 64 bits)."""
    h = F.xxhash64(F.lit(seed), key)
    first, step = F.shiftrightunsigned(h, 32), h.bitwiseAND(F.lit(0xFFFFFFFF)).bitwiseOR(F.lit(1))
    return [(first + step * F.lit(j)) % F.lit(size) for j in range(hashes)]


def _word(position: Column) -> Column:
    return F.shiftright(position, 6)


def _bit(position: Column) -> Column:
    return position.bitwiseAND(F.lit(63)).cast("int")


def make_level(keys: DataFrame, n: int, power: int, seed: int) -> Level:
    """A Bloom filter of `n` keys (column `key`) that takes 2^-`power` of others for its own."""
    hashes = max(1, min(MOST_HASHES, power))
    size = max(64, math.ceil(n * hashes / math.log(2) / 64) * 64)
    position = F.explode(F.array(*_positions(F.col("key"), size, hashes, seed))).alias("at")
    bit = F.expr("shiftleft(1L, cast(at & 63 as int))")
    words = keys.select(position).groupBy(_word(F.col("at")).alias("word")).agg(F.bit_or(bit).alias("bits"))
    every = keys.sparkSession.range(size // 64).select(F.col("id").alias("word"), F.lit(0).cast("long").alias("bits"))
    dense = words.unionByName(every).groupBy("word").agg(F.bit_or("bits").alias("bits"))
    ordered = F.array_sort(F.collect_list(F.struct("word", "bits")))
    row = dense.agg(F.transform(ordered, lambda x: x["bits"]).alias("bits"))
    return Level(written(row, "bloom"), size, hashes, seed)


def in_level(level: Level, key: Column) -> Column:
    bits = level.bits.scalar()
    found = F.lit(True)
    for at in _positions(key, level.size, level.hashes, level.seed):
        found = found & (F.bit_get(F.get(bits, _word(at).cast("int")), _bit(at)) == 1)
    return found


class Cascade:
    """Exact membership for every key of the universe it was built over."""

    def __init__(self, levels: list[Level]):
        self.levels = levels

    @property
    def bits(self) -> int:
        return sum(level.size for level in self.levels)

    def has(self, key: Column) -> Column:
        """True if listed. A key that level n (from 1) rejects is listed if n is even."""
        answer = F.lit(len(self.levels) % 2 == 1)
        for n in range(len(self.levels), 0, -1):
            answer = F.when(~in_level(self.levels[n - 1], key), F.lit(n % 2 == 0)).otherwise(answer)
        return answer


def build_cascade(universe: DataFrame, max_bits: int = MAX_BITS) -> Cascade | None:
    """The cascade of a table of distinct keys (`key`, `listed`), stored by the caller.

    None if it would need more than `max_bits`; no level is made that goes beyond.
    """
    inside, outside = universe.where("listed").select("key"), universe.where("NOT listed").select("key")
    counts = universe.agg(F.count_if("listed").alias("inside"), F.count_if(~F.col("listed")).alias("outside")).head()
    n, others = counts["inside"], counts["outside"]
    levels: list[Level] = []
    if n == 0:
        return Cascade(levels)
    # the first level leaves about as many mistakes as there are listed keys
    power = max(1, math.ceil(math.log2(max(2.0, math.sqrt(2) * others / n))))
    left = max_bits
    while True:
        if n * min(power, MOST_HASHES) / math.log(2) + 64 > left:
            return None
        levels.append(level := make_level(inside, n, power, seed=len(levels) + 1))
        left -= level.size
        mistakes = written(outside.where(in_level(level, F.col("key"))), "bloom-mistakes")
        n = mistakes.count()
        if n == 0:
            return Cascade(levels)
        inside, outside, power = mistakes, inside, LATER_BITS


# --- judging ----------------------------------------------------------------------

def key_universe(
    pages: DataFrame, terms: Sequence[str] = TERMS, blocked: DataFrame | None = None, url: str = "url"
) -> DataFrame:
    """key, listed: every host of the corpus once, and whether a listed domain covers it.

    Domains are listed by their names, and by `blocked` (one column, `domain`) if given.
    """
    hosts = pages.select(host_of(F.col(quoted(url))).alias("key")).where("key <> ''").distinct()
    named = hosts.select("key", F.exists(domains(F.col("key")), lambda d: is_listed_name(d, terms)).alias("listed"))
    if blocked is None:
        return named
    above = hosts.select("key", F.explode(domains(F.col("key"))).alias("domain"))
    found = above.join(blocked.select("domain").distinct(), "domain").select("key", F.lit(True).alias("listed"))
    return named.unionByName(found).groupBy("key").agg(F.bool_or("listed").alias("listed"))


def with_list(pages: DataFrame, universe: DataFrame, max_bits: int = MAX_BITS, url: str = "url") -> DataFrame:
    """`pages` with host, path and `listed` for a stored universe of keys."""
    keep = carried(pages, DERIVED)
    value = F.col("row")[url]
    rows = pages.select(F.struct(*[F.col(quoted(c)) for c in pages.columns]).alias("row")).select(
        "row", host_of(value).alias("host"), path_of(value).alias("path")
    )
    cascade = build_cascade(universe, max_bits)
    if cascade is not None:
        known = rows.withColumn("listed", (F.col("host") != "") & cascade.has(F.col("host")))
    else:
        bad = universe.where("listed").select("key")
        known = rows.join(bad, F.col("host") == F.col("key"), "left").withColumn("listed", F.col("key").isNotNull())
    return known.select(*[F.col("row")[c].alias(c) for c in keep], "host", "path", "listed")


def judged(
    pages: DataFrame, rules=RULES, terms: Sequence[str] = TERMS, blocked: DataFrame | None = None,
    max_bits: int = MAX_BITS, url: str = "url",
) -> DataFrame:
    """`pages` with host, path, rule (null if none fits), `listed` and the verdict."""
    universe = written(key_universe(pages, terms, blocked, url), "url-keys")
    known = with_list(pages, universe, max_bits, url)
    fit = fitting_rule(F.col("host"), F.col("path"), rules)
    by_list = F.when(F.col("listed"), "block").otherwise("allow")
    kept = [quoted(c) for c in known.columns if c not in ("host", "path", "listed")]
    return known.withColumn("__fit", fit).select(
        *kept, "host", "path", F.col("__fit.rule").alias("rule"), "listed",
        F.coalesce(F.col("__fit.verdict"), by_list).alias("verdict"),
    )


def accepted(pages: DataFrame, url: str = "url", **options) -> DataFrame:
    """The rows whose verdict is allow, with the columns they came with."""
    inner = pages.select(F.struct(*[F.col(quoted(c)) for c in pages.columns]).alias("row"), F.col(quoted(url)).alias("url"))
    return judged(inner, **options).where("verdict = 'allow'").select("row.*")


def _rule_sql() -> str:
    cases = []
    for verdict, domain, prefix in sorted(RULES, key=lambda r: (-len(r[1] + r[2]), r)):
        fits = f"(host = '{domain}' OR ends_with(host, '.{domain}')) AND starts_with(path, '{prefix}')"
        cases.append((fits, domain + prefix, verdict))
    rule = "CASE " + " ".join(f"WHEN {fits} THEN '{rule}'" for fits, rule, _ in cases) + " END"
    verdict = "CASE " + " ".join(f"WHEN {fits} THEN '{v}'" for fits, _, v in cases)
    return f"{rule} AS rule, listed, {verdict} WHEN listed THEN 'block' ELSE 'allow' END AS verdict"


ORACLE = rf"""
WITH cut AS (
  SELECT page_id,
    translate(coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)([^?#]*)', 1), ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)([^?#]*)', 2), '') AS path
  FROM pages),
named AS (
  SELECT *, CASE WHEN length(host) > {LONGEST_DOMAIN} THEN regexp_replace(right(host, {LONGEST_DOMAIN + 1}), '^[^.]*\.?', '') ELSE host END AS domain
  FROM cut),
known AS (SELECT *, regexp_matches(domain, '(^|[.-])({"|".join(TERMS)})(-[^.]*)?\.') AS listed FROM named)
SELECT page_id, host, path, {_rule_sql()} FROM known
"""
