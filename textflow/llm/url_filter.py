"""URL filters: host and path rules, and a Bloom filter cascade for listed keys.

A cascade answers exactly whether a key of a known universe is listed. Its first
level is a Bloom filter of the listed keys; the second one of the first one's
false positives among the other keys of the universe; the third one of the
listed keys that the second takes for those; and so on until no false positive
is left. A key's answer is given by the first level that does not have it.

The universe is every key of the corpus, so it is cut by a hash into shards, and
each shard gets a cascade of its own, built in one task from the hashes of its
keys. Pages are then judged from the cascades alone, without a join. They go to
the tasks in groups of shards of a bounded total size, one pass over the pages a
group.
"""

from __future__ import annotations

import struct
from typing import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from textflow.llm.catalog import query
from textflow.llm.common import col, private_name, written
from textflow.plans.catalog import table

KEYS_A_SHARD = 200_000
BYTES_A_PASS = 64 << 20
BITS_A_KEY = 10
HASHES = 7
MAX_LEVELS = 64

#: (host, path start, verdict); a rule also holds for the host's subdomains.
RULES = (
    ("org", "/", "allow"),
    ("example.org", "/es/", "block"),
    ("example.org", "/en/1", "block"),
    ("com", "/fr/", "allow"),
    ("com", "/de/", "block"),
)

#: Domains that the query lists beside the corpus's own feed links.
LISTED_DOMAINS = ("spam-farm.example.org", "cheap-pills.example.com", "ads-track.example.com")


# --- parts of a URL, and rules (JVM expressions) --------------------------------

def host_of(url: Column) -> Column:
    """Between the first ``://`` and ``/``, ``?``, ``#`` or the end, A-Z in lower
    case; empty without ``://`` or for a null."""
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    return F.translate(F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit("")), upper, lower)


def path_of(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_of(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """The longest fitting rule as text (host and path), and its verdict."""
    text, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for rule_host, start, decision in sorted(rules, key=lambda r: (len(r[0] + r[1]), r)):
        fits = ((host == rule_host) | host.endswith("." + rule_host)) & path.startswith(start)
        text, verdict = F.when(fits, F.lit(rule_host + start)).otherwise(text), F.when(fits, F.lit(decision)).otherwise(verdict)
    return text, verdict


def keys_of(host: Column, path: Column) -> Column:
    """The keys a URL is listed by: its host, every domain above it, and host with
    path; none for an empty host."""
    labels = F.split(host, r"\.")
    domains = F.transform(F.sequence(F.lit(1), F.size(labels)),
                          lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    return F.when(host == "", F.array().cast("array<string>")).otherwise(
        F.array_distinct(F.concat(domains, F.array(F.concat(host, F.lit(" "), path)))))


# --- the cascade ----------------------------------------------------------------

def _mixed(h: np.ndarray, level: int) -> np.ndarray:
    """The hashes drawn anew for a level (multiply and shift), so that keys that
    collide in one level do not in the next."""
    h = h + np.uint64(((2 * level + 1) * 0x9E3779B97F4A7C15) & 0xFFFFFFFFFFFFFFFF)
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


class Bloom:
    """A Bloom filter over pairs of 64-bit hashes; ``level`` seeds it."""

    def __init__(self, level: int, bits: int, words: np.ndarray):
        self.level, self.bits, self.words = level, bits, words

    @classmethod
    def of(cls, level: int, h1: np.ndarray, h2: np.ndarray) -> "Bloom":
        bits = max(64, -(-BITS_A_KEY * len(h1) // 64) * 64)
        made = cls(level, bits, np.zeros(bits // 8, np.uint8))
        for at in made._places(h1, h2):
            np.bitwise_or.at(made.words, at >> 3, np.left_shift(1, at & 7).astype(np.uint8))
        return made

    def _places(self, h1: np.ndarray, h2: np.ndarray):
        at, step = _mixed(h1, self.level), _mixed(h2, self.level) | np.uint64(1)
        for k in range(HASHES):
            yield ((at + np.uint64(k) * step) % np.uint64(self.bits)).astype(np.int64)

    def has(self, h1: np.ndarray, h2: np.ndarray) -> np.ndarray:
        found = np.ones(len(h1), bool)
        for at in self._places(h1, h2):
            found &= (self.words[at >> 3] >> (at & 7).astype(np.uint8)) & 1 == 1
        return found


def build_cascade(h1: np.ndarray, h2: np.ndarray, listed: np.ndarray) -> list[Bloom]:
    """Levels for the distinct keys ``(h1, h2)`` (uint64) of a universe."""
    levels: list[Bloom] = []
    inside, outside = np.flatnonzero(listed), np.flatnonzero(~listed)
    while len(inside):
        if len(levels) == MAX_LEVELS:
            raise RuntimeError("the cascade does not end: keys of equal hashes")
        levels.append(Bloom.of(len(levels), h1[inside], h2[inside]))
        inside, outside = outside[levels[-1].has(h1[outside], h2[outside])], inside
    return levels


def in_cascade(levels: list[Bloom], h1: np.ndarray, h2: np.ndarray) -> np.ndarray:
    """Which keys are listed: those that leave the cascade after an odd number of
    levels that have them."""
    depth = np.zeros(len(h1), int)
    left = np.arange(len(h1))
    for level in levels:
        left = left[level.has(h1[left], h2[left])]
        depth[left] += 1
    return depth % 2 == 1


def _packed(levels: list[Bloom]) -> bytes:
    return b"".join(struct.pack("<Q", x.bits) + x.words.tobytes() for x in levels)


def _unpacked(data: bytes) -> list[Bloom]:
    levels, at = [], 0
    while at < len(data):
        bits = struct.unpack_from("<Q", data, at)[0]
        levels.append(Bloom(len(levels), bits, np.frombuffer(data, np.uint8, bits // 8, at + 8)))
        at += 8 + bits // 8
    return levels


def build_cascades(universe: DataFrame, listed: DataFrame, keys_a_shard: int = KEYS_A_SHARD) -> tuple[DataFrame, int]:
    """``(shard, cascade)`` for the string column ``key`` of ``universe`` and
    ``listed`` (null keys are no keys, repeated ones count once, and listed keys
    outside the universe are not needed), and the number of shards. The shards
    come from a hash of distinct keys, hence are even; their number follows the
    universe's."""
    both = universe.select("key", F.lit(False).alias("listed"), F.lit(True).alias("met")).union(
        listed.select("key", F.lit(True).alias("listed"), F.lit(False).alias("met"))).where("key IS NOT NULL")
    keys = written(both.groupBy("key").agg(F.max("listed").alias("listed"), F.max("met").alias("met")).where("met").select(
        F.xxhash64("key").alias("h1"), F.xxhash64("key", F.lit(1)).alias("h2"), "listed"), "url-keys")
    shards = max(1, -(-keys.count() // keys_a_shard))

    def build(rows: pd.DataFrame) -> pd.DataFrame:
        h1, h2 = (rows[c].to_numpy(np.int64).view(np.uint64) for c in ("h1", "h2"))
        levels = build_cascade(h1, h2, rows["listed"].to_numpy(bool))
        return pd.DataFrame({"shard": [int(rows["shard"].iloc[0])], "cascade": [_packed(levels)]})

    sharded = keys.withColumn("shard", F.pmod(F.col("h2"), F.lit(shards)))
    return written(sharded.groupBy("shard").applyInPandas(build, "shard long, cascade binary"), "url-cascades"), shards


def with_listed(pages: DataFrame, keys: str, into: str, cascades: DataFrame, shards: int,
                bytes_a_pass: int = BYTES_A_PASS) -> DataFrame:
    """``pages`` with the boolean ``into``: whether any key of the array column
    ``keys`` is listed."""
    sizes = cascades.select("shard", F.octet_length("cascade").alias("size")).where("size > 0").orderBy("shard").collect()
    groups, room = [[]], bytes_a_pass
    for row in sizes:
        if groups[-1] and room < row["size"]:
            groups.append([])
            room = bytes_a_pass
        groups[-1].append(row["shard"])
        room -= row["size"]
    sc = pages.sparkSession.sparkContext
    out = pages.withColumn(into, F.lit(False))
    for n, group in enumerate(g for g in groups if g):
        if n:
            out = written(out, "url-pages")
        h1, h2 = (F.transform(col(out, keys), f) for f in (lambda k: F.xxhash64(k), lambda k: F.xxhash64(k, F.lit(1))))
        rows = cascades.where(F.col("shard").between(group[0], group[-1])).collect()  # at most bytes_a_pass
        shared = sc.broadcast({r["shard"]: bytes(r["cascade"]) for r in rows})

        @F.pandas_udf("boolean")
        def listed(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
            levels = {s: _unpacked(c) for s, c in shared.value.items()}
            for first, second in batches:
                sizes = np.array([len(x) for x in first], int)
                a, b = (np.concatenate([*x, np.zeros(0, np.int64)]).astype(np.int64) for x in (first, second))
                shard, hit = b % shards, np.zeros(len(a), bool)
                for s in np.unique(shard):
                    if s in levels:
                        at = np.flatnonzero(shard == s)
                        hit[at] = in_cascade(levels[s], a[at].view(np.uint64), b[at].view(np.uint64))
                rows = np.repeat(np.arange(len(sizes)), sizes)
                yield pd.Series(np.bincount(rows, weights=hit, minlength=len(sizes)) > 0)

        out = out.withColumn(into, out[into] | listed(h1, h2))
    return out


def judge_urls(pages: DataFrame, listed: DataFrame, rules=RULES, keys_a_shard: int = KEYS_A_SHARD,
               bytes_a_pass: int = BYTES_A_PASS) -> DataFrame:
    """``(page_id, host, path, rule, verdict, listed)``, one row for each of
    ``pages``: the verdict is that of the longest fitting rule; without one, block
    for a URL of which a key is in ``listed`` (string column ``key``), else allow.

    A null URL, or one without ``://``, has an empty host and path and no keys;
    repeated rows get a row each; other columns are ignored; an empty table
    gives an empty one."""
    parts = pages.select(col(pages, "page_id").alias("page_id"), col(pages, "url").cast("string").alias("url"))
    parts = parts.select("page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    keyed = parts.withColumn("keys", keys_of(F.col("host"), F.col("path")))
    cascades, shards = build_cascades(keyed.select(F.explode("keys").alias("key")), listed, keys_a_shard)
    rule, verdict = rule_of(F.col("host"), F.col("path"), rules)
    return with_listed(keyed, "keys", "listed", cascades, shards, bytes_a_pass).select(
        "page_id", "host", "path", rule.alias("rule"),
        F.coalesce(verdict, F.when(F.col("listed"), "block").otherwise("allow")).alias("verdict"), "listed")


def feed_links(pages: DataFrame) -> DataFrame:
    """``key``: host and path of the URLs that the crawl met as feed links."""
    url = F.col("url")
    met = pages.where(url.contains("utm_source=feed") & (host_of(url) != ""))
    return met.select(F.concat(host_of(url), F.lit(" "), path_of(url)).alias("key")).distinct()


_SQL_HOST = "translate(coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_SQL_PATH = "coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '')"


def _sql_fits(host: str, path: str) -> str:
    return f"((host = '{host}' OR ends_with(host, '.{host}')) AND starts_with(path, '{path}'))"


_BY_LENGTH = sorted(RULES, key=lambda r: -len(r[0] + r[1]))
OP4_SQL = f"""
WITH parts AS (SELECT page_id, url, {_SQL_HOST} AS host, {_SQL_PATH} AS path FROM pages),
     feeds AS (SELECT DISTINCT host, path FROM parts WHERE contains(url, 'utm_source=feed') AND host <> ''),
     judged AS (
       SELECT p.page_id, p.host, p.path,
              CASE {' '.join(f"WHEN {_sql_fits(h, s)} THEN '{h}{s}'" for h, s, _ in _BY_LENGTH)} END AS rule,
              CASE {' '.join(f"WHEN {_sql_fits(h, s)} THEN '{v}'" for h, s, v in _BY_LENGTH)} END AS by_rule,
              p.host <> '' AND (EXISTS (SELECT 1 FROM feeds f WHERE f.host = p.host AND f.path = p.path)
                OR {' OR '.join(f"host = '{d}' OR ends_with(host, '.{d}')" for d in LISTED_DOMAINS)}) AS listed
       FROM parts p)
SELECT page_id, host, path, rule, coalesce(by_rule, CASE WHEN listed THEN 'block' ELSE 'allow' END) AS verdict, listed
FROM judged
"""


@query("op4_url_filter", OP4_SQL)
def op4_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    domains = spark.createDataFrame([(d,) for d in LISTED_DOMAINS], "key string")
    return judge_urls(pages, feed_links(pages).union(domains))
