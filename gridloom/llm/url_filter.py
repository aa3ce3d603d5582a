"""URL filter on a sorted digest array.

Rules (host, path, verdict) become one file: 64-bit xxhash keys in ascending order, then the rules' full strings.
Each worker memory-maps its copy of the file, hashes the candidates of every url (each parent domain that is no longer
than the longest rule's, with each prefix of the path that is as long as some rule's), finds them all by one vectorised binary search, and compares the stored
string before it believes a hit, so that equal digests of different strings do no harm.

Defined results: a null url, or one without "://", has an empty host and path and fits no rule; among rules that fit,
the longest string wins; an empty table gives an empty result; rules given twice count once (the last verdict stands);
extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import SparkFiles
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridloom.llm.common import bounded_batches, pick, slices, table, work_path

_HEADER = 5  # unsigned 64-bit numbers: rules, path lengths, bytes of strings and of verdicts, longest host in characters
_LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def split_url(url: str | None) -> tuple[str, str]:
    """Host (A-Z lower-cased) and path as the contract of the filter defines them."""
    if url is None or (at := url.find("://")) < 0:
        return "", ""
    rest = url[at + 3 :]
    for mark in "?#":
        rest = rest.partition(mark)[0]
    host, slash, path = rest.partition("/")
    return host.translate(_LOWER), slash + path


def digest_array(rules: Iterable[tuple[str, str, str]]) -> bytes:
    """rules: (host, path with its leading slash, verdict). The sorted array's file."""
    verdicts: dict[str, str] = {}
    for host, at, verdict in rules:
        verdicts[host.translate(_LOWER) + at] = verdict
    names = sorted({*verdicts.values()})
    keyed = sorted((xxhash.xxh64_intdigest(k.encode()), k.encode(), names.index(v)) for k, v in verdicts.items())
    hosts = [k.index("/") if "/" in k else len(k) for k in verdicts]
    lengths = sorted({len(k) - n for k, n in zip(verdicts, hosts, strict=True)})
    blob, label = b"".join(k for _, k, _ in keyed), "\n".join(names).encode()
    numbers = [len(keyed), len(lengths), len(blob), len(label), max(hosts, default=0)]
    numbers += [h for h, _, _ in keyed]
    numbers += np.cumsum([0, *(len(k) for _, k, _ in keyed)]).tolist()
    numbers += [v for _, _, v in keyed]
    return np.array([*numbers, *lengths], "<u8").tobytes() + blob + label


def publish(spark: SparkSession, data: bytes) -> str:
    """Puts a file into the shared folder and has every executor fetch it; returns the name it has there."""
    path = work_path(spark, "digests")
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    out = place.getFileSystem(spark._jsc.hadoopConfiguration()).create(place)
    out.write(bytearray(data))
    out.close()
    spark.sparkContext.addFile(path)
    return path.rpartition("/")[2]


class DigestArray:
    """A memory-mapped file of digest_array()."""

    def __init__(self, path: str):
        whole = np.memmap(path, np.uint8, "r")
        n, m, size, label, self.longest = (int(x) for x in whole[: _HEADER * 8].view("<u8"))
        at = _HEADER * 8

        def numbers(count: int) -> np.ndarray:
            nonlocal at
            out = whole[at : at + 8 * count].view("<u8")
            at += 8 * count
            return out

        self.keys, self.offsets, self.verdict_at, self.lengths = numbers(n), numbers(n + 1), numbers(n), [int(x) for x in numbers(m)]
        self.blob = whole[at : at + size]
        self.names = bytes(whole[at + size : at + size + label]).decode().split("\n")

    def probe(self, strings: list[str]) -> list[int]:
        """The place of each string, or -1."""
        coded = [s.encode() for s in strings]
        digests = np.fromiter((xxhash.xxh64_intdigest(s) for s in coded), np.uint64, len(coded))
        place = np.searchsorted(self.keys, digests)
        out = [-1] * len(coded)
        for i in np.flatnonzero(place < len(self.keys)):
            at = int(place[i])
            while at < len(self.keys) and self.keys[at] == digests[i]:  # several strings can have one digest
                if self.text(at) == coded[i]:
                    out[i] = at
                    break
                at += 1
        return out

    def text(self, at: int) -> bytes:
        return self.blob[int(self.offsets[at]) : int(self.offsets[at + 1])].tobytes()

    def judge(self, urls: list[str | None]) -> tuple[list[str], list[str], list[str | None], list[str | None]]:
        """Host, path, rule and the rule's verdict of each url."""
        parts = [split_url(u) for u in urls]
        strings: dict[str, int] = {}
        mine: list[list[int]] = []
        for host, path in parts:
            own: list[int] = []
            # no parent domain is longer than the longest host of a rule; a longer host is cut before it is taken apart
            at = 0 if len(host) <= self.longest else host.find(".", len(host) - self.longest - 1) + 1
            while at < len(host) and (at or len(host) <= self.longest):
                for n in self.lengths:
                    if n <= len(path):
                        own.append(strings.setdefault(host[at:] + path[:n], len(strings)))
                at = host.find(".", at) + 1 or len(host)
            mine.append(own)
        place = self.probe(list(strings))
        rules: list[str | None] = []
        verdicts: list[str | None] = []
        for own in mine:
            hits = [self.text(place[i]) for i in own if place[i] >= 0]
            at = max((place[i] for i in own if place[i] >= 0), key=lambda p: (len(self.text(p)), self.text(p)), default=None)
            rules.append(self.text(at).decode() if hits else None)
            verdicts.append(self.names[int(self.verdict_at[at])] if hits else None)
        return [h for h, _ in parts], [p for _, p in parts], rules, verdicts


def url_filter(pages: DataFrame, rules: Iterable[tuple[str, str, str]], default: str = "allow") -> DataFrame:
    """pages (page_id, url): page_id, host, path, rule, verdict; default where no rule fits."""
    spark = pages.sparkSession
    bounded_batches(spark)
    name = publish(spark, digest_array(rules))

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        digests = DigestArray(SparkFiles.get(name))
        for batch in batches:
            for part in slices(batch, "url"):
                host, path, rule, verdict = digests.judge(part.column(1).to_pylist())
                columns = [part.column(0), pa.array(host, pa.string()), pa.array(path, pa.string()), pa.array(rule, pa.string()), pa.array([v or default for v in verdict], pa.string())]
                yield pa.RecordBatch.from_arrays(columns, names=["page_id", "host", "path", "rule", "verdict"])

    slim = pick(pages, "page_id", "url").select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"))
    return slim.mapInArrow(judge, "page_id long, host string, path string, rule string, verdict string")


#: The contract's rules.
RULES = [
    ("com", "/en/", "block"),
    ("example.com", "/en/7", "allow"),
    ("net", "/de/", "allow"),
    ("example.net", "/de/8", "block"),
    ("org", "/es/", "block"),
]


def op3_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter(table(spark, sf_dir, "pages"), RULES)


SQL = """
WITH cut AS (
  SELECT page_id, CASE WHEN url IS NULL OR strpos(url, '://') = 0 THEN '' ELSE substr(url, strpos(url, '://') + 3) END AS rest FROM pages
), parts AS (
  SELECT page_id, split_part(split_part(rest, '?', 1), '#', 1) AS rest FROM cut
), hosts AS (
  SELECT page_id, translate(split_part(rest, '/', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         CASE WHEN strpos(rest, '/') = 0 THEN '' ELSE substr(rest, strpos(rest, '/')) END AS path FROM parts
), rules(rhost, rpath, rverdict) AS (
  VALUES ('com', '/en/', 'block'), ('example.com', '/en/7', 'allow'), ('net', '/de/', 'allow'), ('example.net', '/de/8', 'block'), ('org', '/es/', 'block')
), fits AS (
  SELECT page_id, host, path, rhost || rpath AS rule, rverdict,
         row_number() OVER (PARTITION BY page_id, host, path ORDER BY length(rhost || rpath) DESC NULLS LAST) AS nth
  FROM hosts LEFT JOIN rules ON (host = rhost OR ends_with(host, '.' || rhost)) AND starts_with(path, rpath)
)
SELECT page_id, host, path, rule, coalesce(rverdict, 'allow') AS verdict FROM fits WHERE nth = 1
"""
