"""URL filters: rules on hosts and paths, and a Bloom filter cascade for listed hosts.

The cascade is exact for every key of a known universe. Level one encodes the listed
keys; level two the keys of the universe that level one takes for listed; level three
the listed keys that level two takes for unlisted; and so on until no key is left. The
first level that does not know a key decides it: an even number of levels passed means
unlisted, an odd number listed. As the universe holds every key of the corpus, no answer
is wrong and no join with the list is needed.

All work is expressions (see ``bloom``). A level has twelve bits for each key it encodes.
Levels shrink geometrically, so the cascade grows with the list of keys and not with the
pages. Lists and universes of any size are taken: as a level is one row, keys are dealt by a hash
into as many shares as keep levels near ``most_keys`` keys, each share has a cascade of
its own, and the hash of a key names the one that answers.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from sheafline.llm.bloom import Filter, build, kept

#: Keys of the list in a share at most, in 12 MB of bits.
MOST_KEYS = 8_000_000
#: Other keys in a share for each of these at most: a level takes fewer than one of as many for listed.
OTHERS = 100
#: Seed of the hash that deals keys to shares; levels hash from 0 upwards.
SHARES = -1


@dataclass(frozen=True)
class Rule:
    """Block or allow a host with its subdomains, for paths that begin with ``path``."""

    verdict: str
    host: str
    path: str = "/"

    @property
    def name(self) -> str:
        return self.host + self.path


def _folded(text: Column) -> Column:
    """A-Z in lower case, and nothing else."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def host_and_path(url: Column | str) -> tuple[Column, Column]:
    """Host and path of a URL. Both are empty for a null and without ``://``."""
    url = F.col(url) if isinstance(url, str) else url
    start = F.instr(url, "://")
    rest = F.when(start > 0, F.substr(url, start + 3)).otherwise("")
    host = F.regexp_extract(rest, r"\A[^/?#]*", 0)
    path = F.regexp_extract(F.substr(rest, F.length(host) + 1), r"\A[^?#]*", 0)
    return _folded(host), path


def matching_rule(host: Column, path: Column, rules: Sequence[Rule]) -> Column:
    """Name and verdict of the longest rule that fits, or null.

    A rule fits its host and all hosts below it. Of equally long rules the first by name wins.
    """
    found = F.lit(None).cast("struct<name:string,verdict:string>")
    for rule in sorted(rules, key=lambda r: (-len(r.name), r.name), reverse=True):
        fits = ((host == rule.host) | host.endswith(f".{rule.host}")) & path.startswith(rule.path)
        found = F.when(fits, F.struct(F.lit(rule.name).alias("name"), F.lit(rule.verdict).alias("verdict"))).otherwise(found)
    return found


def _share(key: Column, shares: int) -> Column:
    return F.pmod(F.xxhash64(F.lit(SHARES), key), F.lit(shares))


@dataclass(frozen=True)
class Cascade:
    """The levels of each share of the keys."""

    shares: list[list[Filter]]

    def lists(self, key: Column) -> Column:
        """Whether a key of the universe is listed. A null key is not."""
        own = _share(key, len(self.shares))
        answer = _answer(self.shares[0], key)
        for share, levels in enumerate(self.shares[1:], 1):
            answer = F.when(own == share, _answer(levels, key)).otherwise(answer)
        return F.coalesce(answer, F.lit(False)) & key.isNotNull()


def _answer(levels: list[Filter], key: Column) -> Column:
    answer = F.lit(len(levels) % 2 == 1)
    for level in reversed(levels):
        answer = F.when(~level.knows(key), F.lit(level.number % 2 == 1)).otherwise(answer)
    return answer


def cascade(listed: DataFrame, universe: DataFrame, *, most_keys: int = MOST_KEYS) -> Cascade:
    """The cascade of the keys of ``listed`` over those of ``universe``, columns ``key``.

    ``listed`` may hold keys outside the universe, and both may repeat keys; nulls are left
    out. An empty list gives a cascade without levels, which lists nothing. Shares double in
    number until none holds more than ``most_keys`` keys of the list or ``OTHERS`` times as many others.
    """
    everything = universe.select("key").filter(F.col("key").isNotNull()).distinct()
    wanted = listed.select("key").filter(F.col("key").isNotNull()).distinct()
    # within the universe: other keys are never asked for
    inside = wanted.join(everything, "key", "left_semi")
    outside = everything.join(wanted, "key", "left_anti")
    shares = 1
    while _largest(inside, shares) > most_keys or _largest(outside, shares) > most_keys * OTHERS:
        shares *= 2
    own = [_share(F.col("key"), shares) == share for share in range(shares)]
    return Cascade([_levels(inside.filter(share), outside.filter(share)) for share in own])


def _largest(keys: DataFrame, shares: int) -> int:
    """Keys in the largest of as many shares."""
    return keys.groupBy(_share(F.col("key"), shares).alias("share")).count().agg(F.max("count")).first()[0] or 0


def _levels(encoded: DataFrame, others: DataFrame) -> list[Filter]:
    levels: list[Filter] = []
    while (count := encoded.count()) > 0:
        # the bits are read by every later level and by the answer
        level = kept(build(encoded, count, len(levels)))
        levels.append(level)
        encoded, others = others.filter(level.knows(F.col("key"))), encoded
    return levels


def url_verdicts(pages: DataFrame, *, rules: Sequence[Rule], filters: Cascade, id: str = "page_id", url: str = "url") -> DataFrame:
    """Host, path, rule and verdict of each page: the rule's verdict, else block for a listed host.

    A null URL and one without ``://`` have an empty host and path, which no rule fits.
    """
    host, path = host_and_path(url)
    split = pages.select(F.col(id).alias("page_id"), host.alias("host"), path.alias("path"))
    ruled = split.withColumn("found", matching_rule(F.col("host"), F.col("path"), rules))
    listed = F.when(filters.lists(F.col("host")), F.lit("block")).otherwise("allow")
    return ruled.select(
        "page_id", "host", "path", F.col("found.name").alias("rule"), F.coalesce("found.verdict", listed).alias("verdict")
    )
