"""URL filters: rules on hosts and paths, and lists of hosts, held in cascades of Bloom filters. DataFrame functions only.

A cascade answers "is this key listed?" exactly for every key of a known universe, here all keys that occur in the corpus. Level 0
encodes the listed keys, level 1 the keys of the universe that level 0 takes for listed by mistake, level 2 the listed keys that
level 1 takes for mistakes, and so on until a level makes no mistake. The first level that does not hold a key decides.

Judging a URL is then arithmetic on literals: no join and no shuffle of the pages. A cascade takes about 1.44 * log2(universe /
listed) bits for each listed key (level 0 is tuned to that ratio), so its size follows the list, not the corpus. ``MAX_LISTED`` keys
bound it; longer lists are told by a join on the distinct keys instead, with the same result.

The keys of a URL are its host's last labels followed by a prefix of its path, for the numbers of labels and lengths of
prefixes that occur in the list; so a long host or path has no more keys than a short one.

Defined results: a null URL, or one without ``://``, has empty host and path, fits no rule and is on no list (verdict
``allow``). Rows are judged one by one: repeated rows and null ids pass through. Listed keys that occur nowhere have no effect. Of rules
that fit, the longest host and path together wins. A rule that is listed both ways blocks.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docgraph.plans.scratch import write_table

# Listed keys that one cascade may hold; at some 50 bits each (a billion times as many keys in the universe) 25 MB.
MAX_LISTED = 4_000_000
# False positive rate of the levels after the first.
LATER_RATE = 1 / 16
# Each side shrinks to a 16th with every second level, so a cascade of this height has met keys that its hashes can't tell apart.
MOST_LEVELS = 64

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def url_host(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z in lower case; else empty."""
    return F.translate(F.coalesce(F.regexp_extract(url, r"^(?s:.*?)://([^/?#]*)", 1), F.lit("")), _UPPER, _UPPER.lower())


def url_path(url: Column) -> Column:
    """What follows the host, up to ``?``, ``#`` or the end."""
    return F.coalesce(F.regexp_extract(url, r"^(?s:.*?)://[^/?#]*([^?#]*)", 1), F.lit(""))


@dataclass
class Bloom:
    """A filter as expressions: ``words`` of 64 bits, ``hashes`` positions for each key."""

    words: list[int]
    bits: int
    hashes: int
    seed: int

    @staticmethod
    def build(keys: DataFrame, count: int, rate: float, seed: int) -> Bloom:
        hashes = max(1, math.ceil(math.log2(1 / rate)))
        bits = 64 * math.ceil(max(1, count) * hashes / math.log(2) / 64)
        at = F.explode(F.array(*[_position(F.col("key"), seed, j, bits) for j in range(hashes)])).alias("at")
        bit = F.call_function("shiftleft", F.lit(1).cast("long"), (F.col("at") % 64).cast("int"))
        found = keys.select(at).groupBy(F.floor(F.col("at") / 64).cast("int").alias("word")).agg(F.bit_or(bit).alias("bits"))
        words = [0] * (bits // 64)
        for word, value in found.collect():  # at most bits / 64 rows
            words[word] = value
        return Bloom(words, bits, hashes, seed)

    def holds(self, key: Column) -> Column:
        # A foldable expression: Catalyst turns it into one array literal.
        words = F.split(F.lit(",".join(map(str, self.words))), ",").cast("array<bigint>")
        result = F.lit(True)
        for j in range(self.hashes):
            at = _position(key, self.seed, j, self.bits)
            word = F.get(words, F.floor(at / 64).cast("int"))
            result = result & (F.call_function("shiftright", word, (at % 64).cast("int")).bitwiseAND(F.lit(1)) == 1)
        return result


def _position(key: Column, seed: int, j: int, bits: int) -> Column:
    # The number comes first: hashed the other way round, two keys that once have the same hash would have it for every number.
    return F.pmod(F.xxhash64(F.lit(1000 * seed + j), key), F.lit(bits).cast("long"))


@dataclass
class Listed:
    """Exact membership in a list, for keys of the universe it was built over."""

    levels: list[Bloom]
    keys: DataFrame | None = None

    def holds(self, key: Column) -> Column:
        """Whether a key is listed; only for lists that fit a cascade."""
        result = F.lit(len(self.levels) % 2 == 1)
        for k, level in reversed(list(enumerate(self.levels))):
            result = F.when(level.holds(key), result).otherwise(F.lit(k % 2 == 1))
        return result


def build_cascade(universe: DataFrame, listed: DataFrame, max_listed: int = MAX_LISTED) -> Listed:
    """``universe``: all distinct keys that will ever be asked for; ``listed``: the listed ones, and any others."""
    listed = write_table(listed.select("key").distinct().join(universe.select("key"), "key", "left_semi"), "listed")
    count, total = listed.count(), universe.count()
    if not count:
        return Listed([])
    if count > max_listed:
        return Listed([], listed)
    levels = [Bloom.build(listed, count, min(0.5, count / (math.sqrt(2) * total)), 0)]
    # Candidates for a mistake of the next level, on either side: (wanted by the last level, not wanted by it).
    wanted = listed
    others = write_table(universe.select("key").filter(levels[0].holds(F.col("key"))).join(listed, "key", "left_anti"), "mistakes")
    while mistakes := others.count():
        if len(levels) == MOST_LEVELS:
            raise RuntimeError(f"{mistakes} keys are not told apart by {MOST_LEVELS} levels")
        level = Bloom.build(others, mistakes, LATER_RATE, len(levels))
        levels.append(level)
        wanted, others = others, write_table(wanted.filter(level.holds(F.col("key"))), "mistakes")
    return Listed(levels)


def _shapes(rules: DataFrame) -> list[tuple[int, int]]:
    """Numbers of labels and path lengths that occur in the rules, the longest first."""
    labels = F.size(F.split("host", r"\."))
    shapes = rules.select(labels.alias("labels"), F.length("path").alias("length")).distinct().collect()
    return sorted(map(tuple, shapes), reverse=True)


def _keys(host: Column, path: Column, shapes: list[tuple[int, int]]) -> Column:
    """The keys of a URL, an array with one entry per shape, null where the URL is too short."""
    have = F.length(host) - F.length(F.replace(host, F.lit("."), F.lit(""))) + 1
    keys = [
        F.when(
            (host != "") & (have >= labels) & (F.length(path) >= length),
            F.concat(F.substring_index(host, ".", -labels), F.substring(path, 1, length)),
        )
        for labels, length in shapes
    ]
    return F.array(*keys) if keys else F.array().cast("array<string>")


def judge_urls(pages: DataFrame, rules: DataFrame, blocked_hosts: DataFrame, max_listed: int = MAX_LISTED) -> DataFrame:
    """The rows of ``pages`` (``page_id``, ``url``, any others) as ``page_id``, ``host``, ``path``, ``rule``, ``verdict``.

    ``rules``: ``host``, ``path``, ``verdict`` (allow or block); one fits its host and all subdomains if the path starts
    with its path. ``blocked_hosts``: ``host``; these and their subdomains are blocked where no rule fits.
    """
    urls = pages.select("page_id", url_host(F.col("url")).alias("host"), url_path(F.col("url")).alias("path"))
    hosts = blocked_hosts.select("host", F.lit("").alias("path"))
    rules = write_table(rules.select("host", "path", "verdict").filter("host <> ''"), "rules")
    hosts = write_table(hosts.filter("host <> ''").distinct(), "hosts")
    keys = _keys(F.col("host"), F.col("path"), _shapes(rules))
    host_keys = _keys(F.col("host"), F.col("path"), _shapes(hosts))

    asked = urls.select(F.explode(F.concat(keys, host_keys)).alias("key")).filter("key is not null").distinct()
    universe = write_table(asked, "universe")
    named = rules.select(F.concat("host", "path").alias("key"), "verdict")
    lists = {
        "block": build_cascade(universe, named.filter("verdict = 'block'"), max_listed),
        "allow": build_cascade(universe, named.filter("verdict <> 'block'"), max_listed),
        "hosts": build_cascade(universe, hosts.select(F.concat("host", "path").alias("key")), max_listed),
    }
    if any(x.keys is not None for x in lists.values()):
        return _judge_by_join(urls, keys, host_keys, named, hosts)

    def longest(listed: Listed) -> Column:
        fitting = F.filter(keys, lambda k: k.isNotNull() & listed.holds(k))
        # The longest key, and of equally long ones that with the longer host, which stands first.
        return F.aggregate(fitting, F.lit(""), lambda best, k: F.when(F.length(k) > F.length(best), k).otherwise(best))

    judged = urls.withColumns({"blocking": longest(lists["block"]), "allowing": longest(lists["allow"])})
    listed_host = F.exists(host_keys, lambda k: F.coalesce(lists["hosts"].holds(k), F.lit(False)) & k.isNotNull())
    blocks = F.length("blocking") >= F.length("allowing")
    rule = F.nullif(F.when(blocks, F.col("blocking")).otherwise(F.col("allowing")), F.lit(""))
    verdict = F.when(rule.isNull(), F.when(listed_host, "block").otherwise("allow")).when(blocks, "block").otherwise("allow")
    return judged.select("page_id", "host", "path", rule.alias("rule"), verdict.alias("verdict"))


def _judge_by_join(urls: DataFrame, keys: Column, host_keys: Column, named: DataFrame, hosts: DataFrame) -> DataFrame:
    """The same for lists beyond the bound: distinct hosts with their path prefixes are joined to the lists."""
    prefixes = urls.select("host", "path", keys.alias("keys"), host_keys.alias("host_keys")).distinct()
    one = named.groupBy("key").agg(F.when(F.max(F.col("verdict") == "block"), "block").otherwise("allow").alias("verdict"))
    fitting = prefixes.select("host", "path", F.posexplode("keys").alias("at", "key")).join(one, "key")
    best = F.struct(F.length("key").alias("length"), (F.col("verdict") == "block").alias("blocks"), (-F.col("at")).alias("at"), "key")
    best = fitting.groupBy("host", "path").agg(F.max(best).alias("best"))
    listed = prefixes.select("host", "path", F.explode("host_keys").alias("key"))
    listed = listed.join(hosts.select(F.concat("host", "path").alias("key")), "key", "left_semi")
    listed = listed.select("host", "path").distinct().withColumn("on_list", F.lit(True))
    told = urls.join(best, ["host", "path"], "left").join(listed, ["host", "path"], "left")
    verdict = F.when(F.coalesce("best.blocks", "on_list", F.lit(False)), "block").otherwise("allow")
    return told.select("page_id", "host", "path", F.col("best.key").alias("rule"), verdict.alias("verdict"))
