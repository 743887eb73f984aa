"""URL filters over a sorted digest array.

Entries are strings, sorted by their 64-bit xxhash. The keys lie in one file
of little-endian integers that each worker maps into memory, so that workers
of a machine share its pages; a batch of probes is one vectorised binary
search, and a hit counts only if the stored string is equal.

A list may also be a table. Up to a bound in bytes it becomes one such array on every
machine. Beyond it the list is cut into parts by a hash of the host; only the distinct
domains of the pages travel to their part and are searched there.
"""

from __future__ import annotations

import functools
import hashlib
import os

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import SparkFiles
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import per_batch, written

SCHEMA = "page_id bigint, url string, host string, path string, rule string, verdict string"

#: Rules of the contract, as host, path and verdict.
RULES = (
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
)
#: Listed sites. Each name stands for its .com, .net and .org domain below "example".
LISTED_SITES = ("ads-track", "adult-x", "casino-win", "cheap-pills", "free-bets", "spam-farm")
LISTED_HOSTS = tuple(f"{site}.example.{top}" for site in LISTED_SITES
                     for top in ("com", "net", "org"))
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_TO_LOWER = str.maketrans(_UPPER, _LOWER)


class DigestArray:
    """A fixed set of strings that is searched by vectorised binary search."""

    def __init__(self, packed: bytes, mapped: bool = True):
        """``packed``: number of strings, sorted keys, ends of strings, then the strings.
        An array that one task alone searches need not be ``mapped``."""
        size = int(np.frombuffer(packed, "<u8", 1)[0])
        body = 8 + 16 * size
        if not mapped:
            self.keys = np.frombuffer(packed, "<u8", size, 8)
            self.ends = np.frombuffer(packed, "<u8", size, 8 + 8 * size)
            self.strings = np.frombuffer(packed, np.uint8, offset=body)
            return
        name = f"digests-{hashlib.sha256(packed).hexdigest()[:24]}"
        path = os.path.join(SparkFiles.getRootDirectory(), name)
        if not os.path.exists(path):
            part = f"{path}.{os.getpid()}"
            with open(part, "wb") as file:
                file.write(packed)
            os.replace(part, path)
        self.keys = np.memmap(path, "<u8", "r", 8, (size,)) if size else np.empty(0, "<u8")
        self.ends = np.memmap(path, "<u8", "r", 8 + 8 * size, (size,)) if size else self.keys
        self.strings = (np.memmap(path, np.uint8, "r", body) if len(packed) > body
                        else np.empty(0, np.uint8))

    @staticmethod
    def pack(strings: list[str], max_bytes: int = 256 * 2**20) -> bytes:
        """The file's content. A list above ``max_bytes`` is refused, since every machine gets it."""
        entries = sorted({(xxhash.xxh64_intdigest(s.encode()), s.encode()) for s in strings})
        stored = [s for _, s in entries]
        packed = b"".join([
            np.array([len(entries), *(k for k, _ in entries)], "<u8").tobytes(),
            np.cumsum([len(s) for s in stored], dtype="<u8").tobytes() if stored else b"",
            *stored])
        if len(packed) > max_bytes:
            raise ValueError(f"a list of {len(packed)} bytes is above the bound of {max_bytes}")
        return packed

    def contains(self, probes: list[str]) -> np.ndarray:
        """Which probes are among the strings."""
        found = np.zeros(len(probes), bool)
        if not len(self.keys) or not probes:
            return found
        encoded = [p.encode() for p in probes]
        keys = np.fromiter(map(xxhash.xxh64_intdigest, encoded), np.uint64, len(encoded))
        at = np.searchsorted(self.keys, keys)
        hits = np.flatnonzero(self.keys[np.minimum(at, len(self.keys) - 1)] == keys)
        for i in hits.tolist():
            entry = int(at[i])
            # Strings with equal keys lie side by side.
            while not found[i] and entry < len(self.keys) and self.keys[entry] == keys[i]:
                start = int(self.ends[entry - 1]) if entry else 0
                found[i] = self.strings[start:int(self.ends[entry])].tobytes() == encoded[i]
                entry += 1
        return found


def parse(url: str | None) -> tuple[str, str]:
    """Host and path as the contract has them."""
    _, mark, rest = (url or "").partition("://")
    if not mark:
        return "", ""
    end = min((i for i in map(rest.find, "/?#") if i >= 0), default=len(rest))
    path = rest[end:]
    stop = min((i for i in map(path.find, "?#") if i >= 0), default=len(path))
    return rest[:end].translate(_TO_LOWER), path[:stop]


def _suffixes(host: str, most_labels: int) -> list[str]:
    """The host and the domains above it that have at most ``most_labels`` labels."""
    labels = host.rsplit(".", most_labels)
    tail = labels[1:] if len(labels) > most_labels else labels
    return [".".join(tail[i:]) for i in range(len(tail))]


class UrlJudge:
    """Rules and listed hosts as two digest arrays."""

    def __init__(self, rules: bytes, hosts: bytes, verdicts: dict[str, str],
                 path_lengths: tuple[int, ...], labels: int):
        self.rules, self.hosts = DigestArray(rules), DigestArray(hosts)
        self.verdicts, self.path_lengths, self.labels = verdicts, path_lengths, labels

    def judge(self, urls: list[str | None]) -> dict[str, list]:
        parsed = [parse(u) for u in urls]
        probes, owner, host_probes, host_owner = [], [], [], []
        for i, (host, path) in enumerate(parsed):
            for domain in _suffixes(host, self.labels) if host else ():
                host_probes.append(domain)
                host_owner.append(i)
                for n in self.path_lengths:
                    if n <= len(path):
                        probes.append(f"{domain}{path[:n]}")
                        owner.append((i, len(domain)))
        # Longest rule wins; of equal ones that with the longer host.
        best: dict[int, tuple[int, int, str]] = {}
        for k in np.flatnonzero(self.rules.contains(probes)).tolist():
            i, host_length = owner[k]
            best[i] = max(best.get(i, (0, 0, "")), (len(probes[k]), host_length, probes[k]))
        listed = {host_owner[k] for k in np.flatnonzero(self.hosts.contains(host_probes)).tolist()}
        rule = [best[i][2] if i in best else None for i in range(len(urls))]
        return {
            "host": [h for h, _ in parsed], "path": [p for _, p in parsed], "rule": rule,
            "verdict": [self.verdicts[r] if r is not None else "block" if i in listed else "allow"
                        for i, r in enumerate(rule)],
        }


@functools.lru_cache(maxsize=4)
def judge_for(rules: bytes, hosts: bytes, verdicts: tuple, lengths: tuple, labels: int) -> UrlJudge:
    """One judge per pair of lists and worker process."""
    return UrlJudge(rules, hosts, dict(verdicts), lengths, labels)


def judge_urls(
    pages: DataFrame,
    rules: tuple[tuple[str, str, str], ...] = RULES,
    hosts: tuple[str, ...] | DataFrame = LISTED_HOSTS,
    max_bytes: int = 256 * 2**20,
    array_bytes: int = 32 * 2**20,
) -> DataFrame:
    """Host, path, rule and verdict of each page's url.

    The longest fitting rule decides. Without a rule, a host that is listed, or
    lies below a listed one, is blocked and any other allowed. A NULL url and
    one without ``://`` have empty host and path, fit no rule and are allowed.
    Each row gives one row; ``page_id`` may be NULL and may repeat.

    ``hosts`` are strings, or a table with a column ``host`` of which A-Z are lower-cased,
    NULL and empty ones left out, and repeated ones count once. Strings go to every
    machine, ``max_bytes`` bounds them. A table does so up to ``array_bytes``; a larger
    one is searched in parts of about that size, with the same result.
    """
    if isinstance(hosts, tuple):
        return _judged(pages, rules, hosts, max_bytes)
    listed = written(
        hosts.select(F.translate("host", _UPPER, _LOWER).alias("domain"))
        .where("domain <> ''").distinct(), "url-list")
    size = listed.agg(
        F.coalesce(F.sum(F.octet_length("domain") + 16), F.lit(0)).alias("bytes"),
        F.coalesce(F.max(F.size(F.split("domain", r"\."))), F.lit(1)).alias("labels")).first()
    if size["bytes"] <= array_bytes:
        found = listed.toArrow().column("domain").to_pylist()
        return _judged(pages, rules, tuple(found), max_bytes)
    return _judged_in_parts(pages, rules, listed, size["bytes"], size["labels"],
                            max_bytes, array_bytes)


def _judged(pages: DataFrame, rules: tuple, hosts: tuple[str, ...], max_bytes: int) -> DataFrame:
    verdicts = tuple((f"{host}{path}", verdict) for host, path, verdict in rules)
    context = pages.sparkSession.sparkContext
    rule_file = context.broadcast(DigestArray.pack([r for r, _ in verdicts], max_bytes))
    host_file = context.broadcast(DigestArray.pack(list(hosts), max_bytes))
    lengths = tuple(sorted({len(path) for _, path, _ in rules}))
    labels = max((h.count(".") + 1 for h in [*hosts, *(r[0] for r in rules)]), default=1)

    def make():
        judge = judge_for(rule_file.value, host_file.value, verdicts, lengths, labels)

        def step(batch):
            urls = batch.column("url").to_pylist()
            return {"page_id": batch.column("page_id"), "url": batch.column("url"),
                    **judge.judge(urls)}
        return step

    return per_batch(pages.select("page_id", "url"), SCHEMA, make)


def _judged_in_parts(pages: DataFrame, rules: tuple, listed: DataFrame, list_bytes: int,
                     labels: int, max_bytes: int, array_bytes: int) -> DataFrame:
    """As :func:`judge_urls` with a list that no machine has to hold whole.

    A host is probed once however many pages it has, and a domain once however many
    hosts lie below it.
    """
    judged = written(_judged(pages, rules, (), max_bytes), "url-judged")
    hosts = judged.where("rule IS NULL AND host <> ''").select("host").distinct()
    probes = written(
        hosts.select("host", F.explode(_domains("host", labels)).alias("domain")), "url-probes")
    domains = probes.select("domain").distinct()
    asked = domains.agg(F.sum(F.octet_length("domain") + 16)).first()[0] or 0
    parts = -(-max(list_bytes, asked) // array_bytes)
    part = F.pmod(F.xxhash64("domain"), F.lit(parts)).alias("part")

    def search(held: pa.Table, asking: pa.Table) -> pa.Table:
        array = DigestArray(DigestArray.pack(held.column("domain").to_pylist(), 2**62), False)
        names = asking.column("domain").to_pylist()
        return asking.select(["domain"]).filter(pa.array(array.contains(names), pa.bool_()))

    hits = listed.select("domain", part).groupBy("part").cogroup(
        domains.select("domain", part).groupBy("part")).applyInArrow(search, "domain string")
    blocked = probes.join(hits, "domain").select("host").distinct().withColumn(
        "_listed", F.lit(True))
    return judged.join(blocked, "host", "left").select(
        "page_id", "url", "host", "path", "rule",
        F.when(F.col("rule").isNull() & F.col("_listed"), "block")
        .otherwise(F.col("verdict")).alias("verdict"))


def _domains(host: str, most_labels: int) -> Column:
    """As :func:`_suffixes`, as a column."""
    labels = F.split(host, r"\.")
    return F.transform(
        F.sequence(F.lit(1), F.least(F.size(labels), F.lit(most_labels))),
        lambda n: F.array_join(F.slice(labels, -n, n), "."))
