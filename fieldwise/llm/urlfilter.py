"""Operator 5: URL filter by a Bloom filter cascade, in DataFrame functions alone.

The first level is a Bloom filter of the listed keys. The second encodes the
keys of the universe that the first lets through by mistake, the third the
listed keys that the second lets through, and so on until a level lets nothing
through. The first level that lacks a key decides, so membership is exact for
every key of the universe, from bits and without a join to the list.

The universe is all keys of the corpus, written once. A level's bits are
aggregated in Spark, a row of 64 at a time, into one array a shard. Up to
``MAX_BITS`` bits the cascade is one shard and reaches the rows as a scalar
subquery; a longer list is dealt into shards of that size, which are joined to
the rows by shard number (the filters, never the keys).

Rules come before the list: a rule ``host/path`` fits its host and all
subdomains where the url's path starts with the rule's; the longest wins.

Defined results: a null url, or one without ``://``, has an empty host and path,
fits no rule, and its empty host is a key like any other. Repeated urls get
equal results, other columns are not read, and an empty list lists nothing.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import written

BITS_PER_KEY = 10
HASHES = 6
MAX_BITS = 1 << 26
#: The rules of the query's contract.
RULES = (
    ("org/", "allow"),
    ("example.org/es/", "block"),
    ("example.org/en/1", "block"),
    ("com/fr/", "allow"),
    ("com/de/", "block"),
)
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host(url: str) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased."""
    return F.translate(F.regexp_extract(F.coalesce(F.col(url), F.lit("")), "://([^/?#]*)", 1), UPPER, LOWER)


def path(url: str) -> Column:
    """After the host up to ``?``, ``#`` or the end."""
    return F.regexp_extract(F.coalesce(F.col(url), F.lit("")), "://[^/?#]*([^?#]*)", 1)


def _fits(rule: str, host_col: Column, path_col: Column) -> Column:
    rule_host, slash, rule_path = rule.partition("/")
    return ((host_col == rule_host) | host_col.endswith(f".{rule_host}")) & path_col.startswith(slash + rule_path)


def rule_of(rules: Sequence[tuple[str, str]], host_col: Column, path_col: Column) -> Column:
    """(rule, verdict) of the longest rule that fits; null if none does."""
    out = F.lit(None).cast("struct<rule:string,verdict:string>")
    for rule, verdict in sorted(rules, key=lambda r: len(r[0])):
        out = F.when(_fits(rule, host_col, path_col), F.struct(F.lit(rule).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(out)
    return out


def _positions(key: Column, level: Column, bits: Column) -> Column:
    """The key's bit positions in a level of so many bits."""
    a, b = F.xxhash64(key, level, F.lit(1)), F.xxhash64(key, level, F.lit(2))
    # the low 31 bits of each hash: no overflow for any number of hashes
    a, b = a.bitwiseAND(F.lit(0x7FFFFFFF)), b.bitwiseAND(F.lit(0x7FFFFFFF))
    return F.transform(F.sequence(F.lit(0), F.lit(HASHES - 1)), lambda i: F.pmod(a + i * b, bits))


def _holds(key: Column, level: Column, words: Column) -> Column:
    bits = (F.size(words) * 64).cast("bigint")
    bit = lambda p: F.call_function("shiftright", F.element_at(words, F.floor(p / 64).cast("int") + 1), F.pmod(p, F.lit(64)).cast("int"))
    return (F.size(words) > 0) & F.forall(_positions(key, level, bits), lambda p: bit(p).bitwiseAND(F.lit(1)) == 1)


def member(key: Column, levels: Column) -> Column:
    """Whether the cascade's levels list ``key``: the number of levels before the first that lacks it is odd."""
    held = F.transform(levels, lambda words, i: _holds(key, i.cast("int"), words))
    lacking = F.array_position(held, F.lit(False))
    before = F.when(lacking > 0, lacking - 1).otherwise(F.size(levels))
    return F.coalesce(before % 2 == 1, F.lit(False))


def shard(key: Column, shards: int) -> Column:
    return F.pmod(F.xxhash64(key, F.lit(0)), F.lit(shards)).cast("int")


def _level(keys: DataFrame, level: int, words: int, shards: int) -> DataFrame:
    """(shard, level, words): one level's bits; ``words`` of 64 bits in every shard that has keys."""
    at = keys.select("shard", F.explode(_positions(F.col("key"), F.lit(level), F.lit(words * 64).cast("bigint"))).alias("p"))
    word = at.groupBy("shard", F.floor(F.col("p") / 64).cast("int").alias("w")).agg(
        F.bit_or(F.expr("shiftleft(1L, cast(p % 64 as int))")).alias("bits")
    )
    # every word of a shard has a row, so that its sorted list is the bit array
    n = F.col("id")
    places = keys.sparkSession.range(shards * words).select(F.floor(n / words).cast("int").alias("shard"), F.pmod(n, F.lit(words)).cast("int").alias("w"))
    filled = places.join(word, ["shard", "w"], "left").select("shard", "w", F.coalesce("bits", F.lit(0).cast("bigint")).alias("bits"))
    rows = F.array_sort(F.collect_list(F.struct("w", "bits")))
    return filled.groupBy("shard").agg(F.transform(rows, lambda x: x["bits"]).alias("words")).select("shard", F.lit(level).alias("level"), "words")


def build(universe: DataFrame, max_bits: int = MAX_BITS) -> tuple[DataFrame, int]:
    """The cascade of a universe (key, listed): rows (shard, levels), and the number of shards."""
    universe = universe.groupBy("key").agg(F.max("listed").alias("listed")).filter("key is not null")
    universe = written(universe, "universe")
    n = universe.filter("listed").count()
    shards = max(1, -(-n * BITS_PER_KEY // max_bits))
    universe = universe.withColumn("shard", shard(F.col("key"), shards))
    encoded, others = universe.filter("listed"), universe.filter("not listed")
    levels: list[DataFrame] = []
    while n:
        words = max(1, -(-n * BITS_PER_KEY // (64 * shards)))
        bits = written(_level(encoded, len(levels), words, shards), "level")
        if shards == 1:
            met = others.withColumn("words", bits.select("words").scalar())  # one value, not one a row
        else:
            met = others.join(bits.select("shard", "words"), "shard")
        through = met.filter(_holds(F.col("key"), F.lit(len(levels)), F.col("words")))
        levels.append(bits)
        encoded, others = written(through.select("key", "listed", "shard"), "through"), encoded
        n = encoded.count()
    numbers = universe.sparkSession.range(shards).select(F.col("id").cast("int").alias("shard"))
    if not levels:
        return numbers.withColumn("levels", F.array().cast("array<array<bigint>>")), shards
    rows = levels[0]
    for more in levels[1:]:
        rows = rows.unionByName(more)
    by_level = F.map_from_entries(F.collect_list(F.struct("level", "words")))
    found = rows.groupBy("shard").agg(by_level.alias("m"))
    none = F.array().cast("array<bigint>")
    cascade = numbers.join(found, "shard", "left").select(
        "shard", F.transform(F.sequence(F.lit(0), F.lit(len(levels) - 1)), lambda i: F.coalesce(F.element_at("m", i), none)).alias("levels")
    )
    return written(cascade, "cascade"), shards


def with_membership(rows: DataFrame, key: str, cascade: DataFrame, shards: int, name: str = "listed") -> DataFrame:
    """``rows`` with whether the cascade lists their ``key``."""
    if shards == 1:
        rows = rows.withColumn("_levels", cascade.select("levels").scalar())
        return rows.withColumn(name, member(F.col(key), F.col("_levels"))).drop("_levels")
    joined = rows.withColumn("_shard", shard(F.col(key), shards)).join(cascade.withColumnRenamed("shard", "_shard"), "_shard")
    return joined.withColumn(name, member(F.col(key), F.col("levels"))).drop("_shard", "levels")


def judge(
    pages: DataFrame,
    listed: Column,
    rules: Sequence[tuple[str, str]] = RULES,
    id_col: str = "page_id",
    url_col: str = "url",
    max_bits: int = MAX_BITS,
) -> DataFrame:
    """(id, host, path, rule, verdict) of every url: a rule's verdict, else block for the
    hosts that the condition ``listed`` (over column ``host``) puts on the list."""
    rows = pages.select(F.col(id_col), host(url_col).alias("host"), path(url_col).alias("path"))
    universe = rows.select(F.col("host").alias("key"), F.coalesce(listed, F.lit(False)).alias("listed"))
    cascade, shards = build(universe, max_bits)
    rows = rows.withColumn("_rule", rule_of(rules, F.col("host"), F.col("path")))
    rows = with_membership(rows, "host", cascade, shards, "_listed")
    verdict = F.coalesce(F.col("_rule.verdict"), F.when(F.col("_listed"), "block").otherwise("allow"))
    return rows.select(id_col, "host", "path", F.col("_rule.rule").alias("rule"), verdict.alias("verdict"))
