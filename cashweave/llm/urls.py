"""URL filters: allow and block rules, looked up in Bloom filter cascades.

A rule has a host, a path prefix and a verdict. A url asks for a few keys only: the
last n labels of its host with the first m characters of its path, for those (n, m)
that rules have. All keys that the corpus asks for are the key universe. A cascade
encodes a list exactly over it: level 1 is a Bloom filter of the listed keys, level
2 one of the other keys that pass level 1, level 3 one of the listed keys that pass
level 2, and so on until nothing passes wrongly. A key's answer is that of the first
level it does not pass. So membership is an expression over a few bytes of bits, and
no url meets a join.

The first level has so many bits for a listed key that about as many others pass as
are listed; later levels let half pass. All levels together take
len(list) * (1.44 * log2(universe / list) + 6) bits or so, whatever the number of
urls. That size is known before the bits are collected, and checked: lists beyond
`most_bits` are cut into parts by a hash of the key, each with a cascade of its own
in its own filter pass.

Everything is DataFrame functions. Defined cases: a null url, or one without "://",
has an empty host and path, no rule and the default verdict; a rule whose key both
lists have blocks; without rules every url gets the default verdict; repeated rows
are judged one by one; only the columns named are read.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cashweave.llm.base import lower_ascii, staged, table, unnamed

MOST_BITS = 1 << 26
LEAST_BITS = 64
#: Fixed rules of the query.
RULES = (
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
)


class Level:
    """A Bloom filter: `bits` as bytes, `hashes` places for a key."""

    def __init__(self, number: int, size: int, hashes: int, bits: bytes = b""):
        self.number, self.size, self.hashes, self.bits = number, size, hashes, bits

    def places(self, key: Column) -> list[Column]:
        return [F.pmod(F.xxhash64(key, F.lit(self.number * 64 + i)), F.lit(self.size)) for i in range(self.hashes)]

    def passes(self, key: Column) -> Column:
        """True if the key may be encoded here."""
        found = F.lit(True)
        for place in self.places(key):
            byte = F.conv(F.hex(F.lit(self.bits).substr((F.floor(place / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
            found = found & (byte.bitwiseAND(F.element_at(F.array(*[F.lit(1 << b) for b in range(8)]), (place % 8 + 1).cast("int"))) > 0)
        return found


def _level(number: int, keys: DataFrame, count: int, share: float) -> Level:
    """A filter of keys (column key) that lets about `share` of other keys pass."""
    size = max(LEAST_BITS, 8 * math.ceil(1.44 * count * math.log2(1 / share) / 8))
    level = Level(number, size, max(1, round(size / count * math.log(2))) if count * 8 > LEAST_BITS else 2)
    level.hashes = min(level.hashes, 20)
    places = keys.select(F.explode(F.array(*level.places(F.col("key")))).alias("place"))
    words = places.groupBy(F.floor(F.col("place") / 8).cast("long").alias("at")).agg(F.bit_or(F.element_at(F.array(*[F.lit(1 << b) for b in range(8)]), (F.col("place") % 8 + 1).cast("int"))).alias("byte"))
    bits = bytearray(size // 8)
    for row in words.collect():  # at most size / 8 rows
        bits[row["at"]] = row["byte"]
    level.bits = bytes(bits)
    return level


class Cascade:
    """Exact membership of a list, for the keys of the universe that it was built over."""

    def __init__(self, levels: Sequence[Level]):
        self.levels = list(levels)

    def holds(self, key: Column) -> Column:
        answer = F.lit(len(self.levels) % 2 == 1)
        for level in reversed(self.levels):
            answer = F.when(level.passes(key), answer).otherwise(F.lit(level.number % 2 == 0))
        return answer

    @property
    def size(self) -> int:
        return sum(level.size for level in self.levels)


def build_cascade(universe: DataFrame, most_bits: int = MOST_BITS) -> Cascade:
    """universe: distinct keys (column key) with `listed`; listed keys outside the corpus do no harm.

    Raises ValueError before anything is collected if the filters would be larger
    than most_bits; `cascades` then cuts the list.
    """
    counts = universe.agg(F.sum(F.col("listed").cast("long")).alias("listed"), F.count("*").alias("all")).first()
    listed, others = counts["listed"] or 0, counts["all"] - (counts["listed"] or 0)
    if not listed:
        return Cascade([])
    share = min(0.5, listed / max(1, others))
    if listed * (1.44 * math.log2(1 / share) + 6) > most_bits:
        raise ValueError(f"{listed} listed keys need more than {most_bits} bits")
    levels: list[Level] = []
    passing, count = universe.where("listed"), listed
    while count:
        number = len(levels) + 1
        levels.append(_level(number, passing, count, share if number == 1 else 0.5))
        # The next level encodes the keys of the other kind that pass all levels so far.
        passing = universe.where(F.col("listed") == F.lit(number % 2 == 0))
        for level in levels:
            passing = passing.where(level.passes(F.col("key")))
        count = passing.count()
    return Cascade(levels)


def cascades(universe: DataFrame, most_bits: int = MOST_BITS) -> list[tuple[int, Cascade]]:
    """(number of parts, cascade) for each part of the list by hash; one part if it fits."""
    parts = 1
    while True:
        try:
            return [(parts, build_cascade(universe.where(F.pmod(F.xxhash64("key"), F.lit(parts)) == p) if parts > 1 else universe, most_bits)) for p in range(parts)]
        except ValueError:
            parts *= 2


def _holds(built: list[tuple[int, Cascade]], key: Column) -> Column:
    answer = F.lit(False)
    for p, (parts, cascade) in enumerate(built):
        mine = cascade.holds(key) if cascade.levels else F.lit(False)
        answer = mine if parts == 1 else F.when(F.pmod(F.xxhash64(key), F.lit(parts)) == p, mine).otherwise(answer)
    return answer


def split_url(url: Column) -> tuple[Column, Column]:
    """(host, path): what stands after the first "://" up to / ? or #, and then up to ? or #."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, url.substr(at + 3, F.length(url))).otherwise(F.lit(""))
    rest = F.coalesce(rest, F.lit(""))
    return lower_ascii(F.regexp_extract(rest, r"^[^/?#]*", 0)), F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def judge_urls(pages: DataFrame, rules: DataFrame, key: str = "page_id", url: str = "url", default: str = "allow", most_bits: int = MOST_BITS) -> DataFrame:
    """key, host, path, rule and verdict of every row. rules: host, path, verdict (allow or block).

    A rule fits its host and all its subdomains where the path begins with the rule's;
    of several the longest wins. Rule hosts are compared in lower case (A-Z).
    """
    rules = rules.select(lower_ascii(F.col("host")).alias("host"), F.coalesce("path", F.lit("")).alias("path"), "verdict").where("host is not null")
    host, path = split_url(F.col(url))
    parsed = unnamed(pages, key, url).select(F.col(key), host.alias("host"), path.alias("path"))
    # The (labels, characters) that rules have: as many at most as rules, in practice a few.
    shapes = rules.select(F.size(F.split("host", r"\.")).alias("labels"), F.length("path").alias("chars")).distinct().orderBy("labels", "chars").collect()
    if not shapes:
        return parsed.select(key, "host", "path", F.lit(None).cast("string").alias("rule"), F.lit(default).alias("verdict"))
    asked = F.filter(
        F.array(
            *[
                F.when((F.length("path") >= s["chars"]) & (F.col("host") != ""), F.concat(F.substring_index("host", ".", -s["labels"]), F.substring("path", 1, s["chars"]) if s["chars"] else F.lit("")))
                for s in shapes
            ]
        ),
        lambda k: k.isNotNull(),
    )
    asked_keys = parsed.select(F.explode(asked).alias("key")).distinct()
    listed = rules.select(F.concat("host", "path").alias("key"), "verdict")
    tagged = asked_keys.select("key", F.lit(0).alias("allow"), F.lit(0).alias("block")).union(listed.select("key", (F.col("verdict") == "allow").cast("int"), (F.col("verdict") == "block").cast("int")))
    universe = staged(tagged.groupBy("key").agg((F.max("allow") > 0).alias("allow"), (F.max("block") > 0).alias("block")), "url-keys")
    blocks = cascades(universe.select("key", F.col("block").alias("listed")), most_bits)
    allows = cascades(universe.select("key", F.col("allow").alias("listed")), most_bits)
    hits = F.transform(asked, lambda k: F.struct(F.length(k).alias("length"), k.alias("rule"), F.when(_holds(blocks, k), F.lit("block")).when(_holds(allows, k), F.lit("allow")).alias("verdict")))
    best = F.array_max(F.filter(hits, lambda h: h["verdict"].isNotNull()))
    return parsed.withColumn("best", best).select(key, "host", "path", F.col("best.rule").alias("rule"), F.coalesce("best.verdict", F.lit(default)).alias("verdict"))


def op3_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.createDataFrame(list(RULES), "host string, path string, verdict string")
    return judge_urls(table(spark, sf_dir, "pages"), rules)


OP3_SQL = r"""
WITH rest AS (
  SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS r FROM pages),
parts AS (
  SELECT page_id,
         translate(regexp_extract(r, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(r, '^[^/?#]*([^?#]*)', 1) AS path
  FROM rest),
rules(h, p, v) AS (
  VALUES ('com', '/', 'allow'), ('example.com', '/en/', 'block'), ('www.example.com', '/en/', 'allow'),
         ('net', '/es/', 'block'), ('net', '/fr/', 'block')),
pairs AS (
  SELECT host, path, max_by(h || p, length(h || p)) AS rule, max_by(v, length(h || p)) AS v
  FROM (SELECT DISTINCT host, path FROM parts) JOIN rules
    ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p)
  GROUP BY ALL)
SELECT page_id, parts.host AS host, parts.path AS path, rule, coalesce(v, 'allow') AS verdict
FROM parts LEFT JOIN pairs ON parts.host = pairs.host AND parts.path = pairs.path
"""
