"""URL filter: a sorted digest array of rules, probed by vectorised binary search.

A rule is ``host/path``: it fits its host and all subdomains, where the url's path starts with the
rule's path; the longest fitting rule wins (of equal rules with two verdicts, ``block``). The rules
become one binary file: sorted 64-bit xxhash keys, verdicts, string offsets, and the full strings.
Spark ships the file to the executors, whose tasks memory-map it; the candidates of a url (its host
suffixes with its path prefixes, in the depths and lengths that occur among the rules) are hashed and looked up
by binary search, and a key counts only if the stored string is equal.

A file holds at most ``SEGMENT_BYTES`` of rules: a longer list is dealt by hash over several files,
which are probed one after the other, so no task and not the driver ever holds more than one of them.

Edge cases: a null url, or one without ``://``, has an empty host and path and fits no rule; null
rules are left out; an empty table or list works; repeated rows are judged alike; extra columns pass through,
except those named like the added ones.
"""

from __future__ import annotations

import os
import struct
import tempfile
import uuid
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import SparkFiles
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

SEGMENT_BYTES = 64 << 20
#: The rules of the query.
RULES = {
    "net/": "block",
    "example.net/en/": "allow",
    "example.com/de/": "block",
    "org/fr/": "allow",
}
#: What the method blocks where no rule fits: advertising, betting, pills, adult pages and link farms, each name
#: under each domain.
BAD_NAMES = ("ads-track", "adult-x", "casino-win", "cheap-pills", "free-bets", "spam-farm")
DOMAINS = ("com", "net", "org", "example.com", "example.net", "example.org")
LISTED = {f"{name}.{domain}": "block" for name in BAD_NAMES for domain in DOMAINS}  # no slash: the path may be empty
LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
HEAD = struct.Struct("<8sQ")
MAGIC = b"URLDIG01"


def split_url(url: str | None) -> tuple[str, str]:
    """Host (A-Z lower-cased) and path."""
    rest = (url or "").partition("://")[2]
    end = min((i for i in (rest.find("?"), rest.find("#")) if i >= 0), default=len(rest))
    host, slash, path = rest[:end].partition("/")
    return host.translate(LOWER), slash + path


def write_digests(rules: list[tuple[str, str]], folder: str) -> str:
    """Write the file of (rule, verdict) rows; the rules differ from each other."""
    rows = sorted((xxhash.xxh64_intdigest(r.encode()), r.encode(), v == "block") for r, v in rules)
    path = os.path.join(folder, f"urls-{uuid.uuid4().hex}.bin")
    with open(path, "wb") as out:
        out.write(HEAD.pack(MAGIC, len(rows)))
        out.write(np.array([k for k, _, _ in rows], "<u8").tobytes())
        out.write(np.cumsum([0, *(len(r) for _, r, _ in rows)], dtype="<u8").tobytes())
        out.write(bytes(b for _, _, b in rows))
        out.write(b"".join(r for _, r, _ in rows))
    return path


class Digests:
    """The memory-mapped file."""

    def __init__(self, path: str):
        self.map = np.memmap(path, np.uint8, "r")
        magic, n = HEAD.unpack(self.map[: HEAD.size].tobytes())
        if magic != MAGIC:
            raise ValueError(f"{path} is not a digest file")
        at = HEAD.size
        self.keys = self.map[at : at + 8 * n].view("<u8")
        self.offsets = self.map[at + 8 * n : at + 16 * n + 8].view("<u8")
        self.block = self.map[at + 16 * n + 8 : at + 17 * n + 8]
        self.strings = self.map[at + 17 * n + 8 :]

    def find(self, probes: list[bytes]) -> np.ndarray:
        """The index of each probe's rule, or -1."""
        found = np.full(len(probes), -1, np.int64)
        if not len(self.keys) or not probes:
            return found
        keys = np.fromiter((xxhash.xxh64_intdigest(p) for p in probes), np.uint64, len(probes))
        at = np.searchsorted(self.keys, keys)
        for i in np.flatnonzero(self.keys[np.minimum(at, len(self.keys) - 1)] == keys):
            j = at[i]
            while j < len(self.keys) and self.keys[j] == keys[i]:  # keys that collide stand side by side
                if self.strings[int(self.offsets[j]) : int(self.offsets[j + 1])].tobytes() == probes[i]:
                    found[i] = j
                    break
                j += 1
        return found


@lru_cache(maxsize=4)
def opened(name: str) -> Digests:
    return Digests(SparkFiles.get(name))


def judge(urls: list[str | None], digests: Digests, depths: list[int], lengths: list[int]) -> tuple[list, list, list, list]:
    """Host, path, rule and verdict (null without a rule) of each url. ``depths`` and ``lengths``: how
    many labels the hosts, and characters the paths, of the rules have."""
    parts = [split_url(u) for u in urls]
    owner, probes, sizes = [], [], []
    for i, (host, path) in enumerate(parts):
        if not host:
            continue
        labels = host.rsplit(".", max(depths, default=0))
        for d in depths:
            whole = d == len(labels) and "." not in labels[0]
            if d < len(labels) or whole:
                suffix = ".".join(labels[-d:])
                for n in lengths:
                    if n <= len(path):
                        owner.append(i)
                        probes.append((suffix + path[:n]).encode())
                        sizes.append(len(suffix) + n)
    rule: list = [None] * len(urls)
    verdict: list = [None] * len(urls)
    best = [-1] * len(urls)
    found = digests.find(probes)
    for k in np.flatnonzero(found >= 0):
        if sizes[k] > best[owner[k]]:
            best[owner[k]] = sizes[k]
            rule[owner[k]] = probes[k].decode()
            verdict[owner[k]] = "block" if digests.block[found[k]] else "allow"
    return [h for h, _ in parts], [p for _, p in parts], rule, verdict


def rule_table(spark: SparkSession, rules: dict[str, str]) -> DataFrame:
    return spark.createDataFrame([Row(rule=r, verdict=v) for r, v in rules.items()], "rule string, verdict string")


def filter_urls(pages: DataFrame, rules: DataFrame, url: str = "url", prefix: str = "") -> DataFrame:
    """``pages`` without other columns named so, with ``host``, ``path``, ``rule`` and ``verdict``
    (both null without a rule). ``rules`` has rule and verdict; ``prefix`` stands before the names
    of the last two."""
    spark = pages.sparkSession
    rules = rules.filter("rule is not null and verdict is not null").groupBy("rule").agg(F.max("verdict").alias("verdict"))
    size = rules.agg(F.sum(F.octet_length("rule") + 17)).first()[0] or 0
    files = max(1, -(-size // SEGMENT_BYTES))
    names = ["host", "path", f"{prefix}rule", f"{prefix}verdict"]
    out = pages.drop(*names).withColumns({n: F.lit(None).cast("string") for n in names})
    for i in range(files):
        own = rules.filter(F.pmod(F.xxhash64("rule"), F.lit(files)) == i).toPandas()
        pairs = list(zip(own["rule"], own["verdict"], strict=True))
        path = write_digests(pairs, os.path.realpath(tempfile.mkdtemp(prefix="urls-")))
        spark.sparkContext.addFile(path)
        parts = [r.partition("/") for r, _ in pairs]
        depths = sorted({h.count(".") + 1 for h, _, _ in parts})
        lengths = sorted({len(s + p) for _, s, p in parts})
        out = probe(out, url, names, os.path.basename(path), depths, lengths)
    return out


def probe(df: DataFrame, url: str, names: list[str], file: str, depths: list[int], lengths: list[int]) -> DataFrame:
    """Judge by one file, keeping a longer rule that an earlier file gave."""
    kept = [c for c in df.columns if c not in names]
    schema = df.select(*kept, *names).schema
    string = to_arrow_type(schema[names[0]].dataType)
    at = kept.index(url)

    def run(batches):
        digests = opened(file)
        for batch in batches:
            host, path, rule, verdict = judge(batch.column(at).to_pylist(), digests, depths, lengths)
            before = zip(batch.column(len(kept) + 2).to_pylist(), batch.column(len(kept) + 3).to_pylist(), strict=True)
            for i, (r, v) in enumerate(before):
                if r is not None and len(r) > len(rule[i] or ""):
                    rule[i], verdict[i] = r, v
            added = [pa.array(x, string) for x in (host, path, rule, verdict)]
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(kept)], *added], names=[*kept, *names])

    return df.select(*kept, *names).mapInArrow(run, schema)
