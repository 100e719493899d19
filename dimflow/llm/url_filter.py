"""URL filters: host and path rules, and exact membership in a list by a cascade of Bloom filters.

Levels alternate: the first encodes the listed keys, the second the keys of the corpus that the
first wrongly lets pass, the third the listed keys that the second wrongly lets pass, and so on until
nothing passes wrongly. For every key of the corpus the first level that it fails tells the truth,
so pages are judged in a scan without a join. All of it is DataFrame functions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from dimflow.llm.common import table
from dimflow.session import cut_lineage

#: Host, path, verdict. The longest that fits decides.
RULES = [("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow")]
#: Hosts with one of these labels are on the list of the query.
LISTED_LABELS = ["ads-track", "adult-x", "casino-win", "cheap-pills", "free-bets", "spam-farm"]
#: Hash functions and bits for each key. A level of 64 bits or more has a power of two of them.
HASHES, BITS_PER_KEY = 7, 10
#: A larger level is not held as one filter; the list is joined then.
MOST_BITS = 1 << 26


def url_parts(url: Column) -> tuple[Column, Column]:
    """Host and path: both empty for null and where ``://`` is missing."""
    there = F.coalesce(F.instr(url, "://"), F.lit(0)) > 0
    rest = F.substr(url, F.instr(url, "://") + 3)
    host = F.regexp_extract(rest, "^[^/?#]*", 0)
    path = F.regexp_extract(F.substr(rest, F.length(host) + 1), "^[^?#]*", 0)
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return F.when(there, F.translate(host, upper, upper.lower())).otherwise(""), F.when(there, path).otherwise("")


def rule_of(host: Column, path: Column, rules: list[tuple[str, str, str]]) -> tuple[Column, Column]:
    """The longest rule that fits and its verdict; nulls if none does."""
    name = verdict = F.lit(None).cast("string")
    for rule_host, rule_path, says in sorted(rules, key=lambda r: (len(r[0] + r[1]), r)):  # later ones wrap earlier
        fits = ((host == rule_host) | F.endswith(host, F.lit("." + rule_host))) & F.startswith(path, F.lit(rule_path))
        name = F.when(fits, F.lit(rule_host + rule_path)).otherwise(name)
        verdict = F.when(fits, F.lit(says)).otherwise(verdict)
    return name, verdict


def places(key: Column, level: int, bits: int) -> list[Column]:
    return [F.pmod(F.xxhash64(key, F.lit(level), F.lit(j)), F.lit(bits)) for j in range(HASHES)]


class Level:
    """One Bloom filter: a written table of one row that holds its words of 64 bits."""

    def __init__(self, keys: DataFrame, number: int, n_keys: int):
        self.number = number
        self.bits = 1 << max(6, (n_keys * BITS_PER_KEY - 1).bit_length())
        place = keys.select(F.explode(F.array(*places(F.col("key"), number, self.bits))).alias("place"))
        words = place.groupBy(F.expr("place div 64").alias("word")).agg(F.bit_or(F.expr("shiftleft(1L, CAST(place % 64 AS INT))")).alias("set"))
        every = keys.sparkSession.range(self.bits // 64).select(F.col("id").alias("word"))
        filled = every.join(words, "word", "left").select("word", F.coalesce("set", F.lit(0)).alias("set"))
        self.row = cut_lineage(filled.agg(F.transform(F.array_sort(F.collect_list(F.struct("word", "set"))), lambda w: w["set"]).alias("words")))

    def passes(self, key: Column) -> Column:
        words = self.row.scalar()
        passed = F.lit(True)
        for place in places(key, self.number, self.bits):
            passed = passed & (F.getbit(F.get(words, F.floor(place / 64).cast("int")), (place % 64).cast("int")) == 1)
        return passed


def cascade(keys: DataFrame, most_bits: int = MOST_BITS) -> list[Level] | None:
    """Levels for distinct ``key, listed`` rows that hold every key of the corpus; None if one would be too large."""
    levels: list[Level] = []
    encoded = keys.where("listed")
    while n := encoded.count():
        if n * BITS_PER_KEY > most_bits:
            return None
        level = Level(encoded, len(levels), n)
        levels.append(level)
        # Of the other kind, the keys that got through all levels so far.
        other = keys.where(F.col("listed") == (len(levels) % 2 == 0))
        for before in levels[len(levels) % 2 == 0 :: 2] if len(levels) > 2 else levels[-1:]:
            other = other.where(before.passes(F.col("key")))
        encoded = other
    return levels


def is_member(key: Column, levels: list[Level]) -> Column:
    """The number of levels passed in a row is odd for listed keys, even for others."""
    member = F.lit(len(levels) % 2 == 1)
    for i in reversed(range(len(levels))):
        member = F.when(levels[i].passes(key), member).otherwise(F.lit(i % 2 == 1))
    return member


def filter_urls(pages: DataFrame, listed: DataFrame, rules=RULES, most_bits: int = MOST_BITS, id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """One row per page: ``page_id, host, path, rule, verdict``.

    ``listed`` has one string column ``key`` with hosts; pages without a rule are blocked if their host is
    listed. Null urls and those without ``://`` have an empty host and path. Nulls in the list and repeated
    keys count for nothing; an empty list blocks nothing; repeated pages are judged alike; an empty table gives no rows;
    other columns are not looked at. A list whose filters would be larger than ``most_bits`` is joined instead.
    """
    url = F.col(url_col).cast("string")
    host, path = url_parts(url)
    judged = pages.select(F.col(id_col).cast("long").alias("page_id"), host.alias("host"), path.alias("path"))
    seen = judged.select(F.col("host").alias("key"), F.lit(False).alias("listed"), F.lit(True).alias("seen"))
    given = listed.select(F.col("key").cast("string"), F.lit(True).alias("listed"), F.lit(False).alias("seen")).where("key IS NOT NULL")
    keys = cut_lineage(seen.unionByName(given).groupBy("key").agg(F.max("listed").alias("listed"), F.max("seen").alias("seen")))
    levels = cascade(keys.where("seen").select("key", "listed"), most_bits)
    rule, says = rule_of(F.col("host"), F.col("path"), rules)
    if levels is None:
        flagged = judged.join(keys.where("seen").select(F.col("key").alias("host"), "listed"), "host", "left")
        member = F.col("listed")
    else:
        flagged, member = judged, is_member(F.col("host"), levels)
    verdict = F.coalesce(says, F.when(member, "block").otherwise("allow"))
    return flagged.select("page_id", "host", "path", rule.alias("rule"), verdict.alias("verdict"))


def op6_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The list: hosts of the pages with a label of ``LISTED_LABELS``."""
    pages = table(spark, sf_dir, "pages")
    host = url_parts(F.col("url"))[0]
    listed = pages.select(host.alias("key")).where(F.arrays_overlap(F.split("key", "[.]"), F.array(*map(F.lit, LISTED_LABELS)))).distinct()
    return filter_urls(pages, listed)


SQL = r"""
WITH u AS (SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
h AS (SELECT page_id, regexp_extract(rest, '^[^/?#]*') AS raw, rest FROM u),
p AS (SELECT page_id, translate(raw, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
        regexp_extract(substr(rest, length(raw) + 1), '^[^?#]*') AS path FROM h),
r AS (SELECT *, CASE
        WHEN (host = 'example.net' OR suffix(host, '.example.net')) AND starts_with(path, '/en/') THEN 'example.net/en/'
        WHEN (host = 'example.com' OR suffix(host, '.example.com')) AND starts_with(path, '/de/') THEN 'example.com/de/'
        WHEN (host = 'org' OR suffix(host, '.org')) AND starts_with(path, '/fr/') THEN 'org/fr/'
        WHEN (host = 'net' OR suffix(host, '.net')) AND starts_with(path, '/') THEN 'net/' END AS rule FROM p)
SELECT page_id, host, path, rule, CASE
  WHEN rule IN ('example.net/en/', 'org/fr/') THEN 'allow' WHEN rule IS NOT NULL THEN 'block'
  WHEN list_has_any(string_split(host, '.'), ['ads-track', 'adult-x', 'casino-win', 'cheap-pills', 'free-bets', 'spam-farm'])
  THEN 'block' ELSE 'allow' END AS verdict
FROM r
"""
