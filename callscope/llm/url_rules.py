"""URL filter: a sorted array of 64-bit digests, memory-mapped by the tasks.

Rules are strings `host/path`. A rule fits its host and all subdomains if the path of the URL
starts with the rule's path; the longest rule that fits wins (of equal length, the one with the
longer host). Rule strings are kept as XXH64 digests in one sorted file and as text in a second
one, in the same order. A task maps both files, looks all candidate strings of a batch up with
one vectorised binary search, and compares the stored string of each hit, so that two strings
with one digest never give a wrong verdict.

Cases: a null URL, or one without `://`, has an empty host and path and no rule; an empty rule
list leaves every URL to the default verdict; repeated rules count once, and where the same rule
string both allows and blocks, block holds. Rows are judged one by one, so ties, repeated rows and
extra columns change nothing. An empty table gives an empty table.
"""

import hashlib
import os
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark import SparkFiles
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from callscope.llm.common import lower_ascii, read_table
from callscope.llm.registry import register
from callscope.session import scratch_dir

#: The files go to every executor, so their size is checked: as many rules, and as many bytes.
MAX_RULES = 20_000_000
MAX_RULE_BYTES = 1 << 30

VERDICTS = ("allow", "block")


class DigestArray:
    """Stored strings with their verdicts, searched by digest.

    Layout of the one file: the count, the number of distinct path lengths and the longest host,
    then path lengths, sorted digests, string offsets, verdicts, string bytes.
    """

    def __init__(self, path: str):
        head = np.memmap(path, dtype="<i8", mode="r", shape=(3,))
        n, lengths, self.longest_host = (int(x) for x in head)
        at = 24
        self.path_lengths = np.memmap(path, dtype="<i8", mode="r", offset=at, shape=(lengths,)) if lengths else np.empty(0, "i8")
        at += 8 * lengths
        self.digests = np.memmap(path, dtype="<u8", mode="r", offset=at, shape=(n,)) if n else np.empty(0, "u8")
        at += 8 * n
        self.offsets = np.memmap(path, dtype="<i8", mode="r", offset=at, shape=(n + 1,))
        at += 8 * (n + 1)
        self.verdicts = np.memmap(path, dtype="u1", mode="r", offset=at, shape=(n,)) if n else np.empty(0, "u1")
        at += n
        size = int(self.offsets[-1])
        self.strings = np.memmap(path, dtype="u1", mode="r", offset=at, shape=(size,)) if size else np.empty(0, "u1")

    @staticmethod
    def pack(rules: Iterable[tuple[str, str, str]]) -> bytes:
        """`rules`: (verdict, host, path)."""
        verdicts: dict[tuple[str, str], int] = {}
        for verdict, host, path in rules:
            key = (host.lower(), path)
            verdicts[key] = max(verdicts.get(key, 0), VERDICTS.index(verdict))
        if len(verdicts) > MAX_RULES:
            raise ValueError(f"{len(verdicts)} rules; at most {MAX_RULES} are sent to every executor")
        entries = sorted((xxhash.xxh64_intdigest(s := (h + p).encode()), s, v) for (h, p), v in verdicts.items())
        blob = b"".join(s for _, s, _ in entries)
        if len(blob) > MAX_RULE_BYTES:
            raise ValueError(f"{len(blob)} bytes of rules; at most {MAX_RULE_BYTES} are sent to every executor")
        lengths = sorted({len(p) for _, p in verdicts})
        longest = max((len(h) for h, _ in verdicts), default=0)
        return b"".join((
            np.array([len(entries), len(lengths), longest], "<i8").tobytes(),
            np.array(lengths, "<i8").tobytes(),
            np.array([d for d, _, _ in entries], "<u8").tobytes(),
            np.cumsum([0, *(len(s) for _, s, _ in entries)], dtype="<i8").tobytes(),
            np.array([v for _, _, v in entries], "u1").tobytes(),
            blob,
        ))

    def find(self, wanted: list[bytes]) -> np.ndarray:
        """Index of each string, or -1."""
        found = np.full(len(wanted), -1, dtype=np.int64)
        if not len(self.digests) or not wanted:
            return found
        keys = np.fromiter((xxhash.xxh64_intdigest(s) for s in wanted), dtype=np.uint64, count=len(wanted))
        at = np.searchsorted(self.digests, keys)
        hit = np.flatnonzero(self.digests[np.minimum(at, len(self.digests) - 1)] == keys)
        for i in hit:
            j = int(at[i])
            while j < len(self.digests) and self.digests[j] == keys[i]:
                if self.strings[self.offsets[j]:self.offsets[j + 1]].tobytes() == wanted[i]:
                    found[i] = j
                    break
                j += 1
        return found

    def candidates(self, host: str, path: str) -> Iterator[bytes]:
        """Every rule string that could fit, longest first."""
        suffixes = []
        at = max(0, len(host) - self.longest_host)
        if at:  # cut inside a label: the first whole label follows the next dot
            at = host.find(".", at - 1) + 1
            if not at:
                return
        while True:
            suffixes.append(host[at:])
            at = host.find(".", at) + 1
            if not at:
                break
        both = [(len(s) + int(n), len(s), s + path[: int(n)]) for s in suffixes for n in self.path_lengths if n <= len(path)]
        for _, _, text in sorted(both, key=lambda x: (-x[0], -x[1])):
            yield text.encode("utf-8", "surrogatepass")


_OPEN: dict[str, DigestArray] = {}


def _opened(name: str) -> DigestArray:
    if name not in _OPEN:
        _OPEN[name] = DigestArray(SparkFiles.get(name))
    return _OPEN[name]


def publish_rules(spark: SparkSession, rules: Iterable[tuple[str, str, str]]) -> str:
    """Write the array below the shared scratch folder, hand it to all executors; its file name."""
    packed = DigestArray.pack(rules)
    name = f"rules-{hashlib.sha256(packed).hexdigest()[:24]}.bin"
    context = spark.sparkContext
    if name not in getattr(context, "_callscope_rules", set()):
        jvm = spark._jvm
        path = jvm.org.apache.hadoop.fs.Path(os.path.join(scratch_dir(spark, "rules"), name))
        system = path.getFileSystem(spark._jsc.hadoopConfiguration())
        out = system.create(path)
        try:
            out.write(bytearray(packed))
        finally:
            out.close()
        context.addFile(system.makeQualified(path).toString())
        context._callscope_rules = getattr(context, "_callscope_rules", set()) | {name}
    return name


def url_host(url: Column) -> Column:
    """What follows the first `://`, up to `/`, `?` or `#`; empty without `://`."""
    rest = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1)
    return lower_ascii(rest)


def url_path(url: Column) -> Column:
    """From the end of the host up to `?` or `#`."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def judge_urls(spark: SparkSession, host: Column, path: Column, rules: Iterable[tuple[str, str, str]], default: str = "allow") -> Column:
    """struct<rule, verdict>: the rule that holds for a host and path, else null and `default`."""
    name = publish_rules(spark, rules)

    @F.pandas_udf("struct<rule: string, verdict: string>")
    def judge(hosts: pd.Series, paths: pd.Series) -> pd.DataFrame:
        array = _opened(name)
        texts, owners = [], []
        for i, (h, p) in enumerate(zip(hosts, paths, strict=True)):
            if h:
                for text in array.candidates(h, p):
                    texts.append(text)
                    owners.append(i)
        found = array.find(texts)
        rule, verdict = [None] * len(hosts), [default] * len(hosts)
        for at in np.flatnonzero(found >= 0)[::-1]:  # the first candidate of a URL, the longest, is set last
            rule[owners[at]] = texts[at].decode("utf-8", "surrogatepass")
            verdict[owners[at]] = VERDICTS[array.verdicts[found[at]]]
        return pd.DataFrame({"rule": pd.Series(rule, dtype=object), "verdict": verdict})

    return judge(host, path)


def filter_urls(pages: DataFrame, rules: Iterable[tuple[str, str, str]], default: str = "allow", url: str = "url") -> DataFrame:
    """`pages` with `host`, `path`, `rule` and `verdict`, which replace columns of these names."""
    spark = pages.sparkSession
    kept = [F.col(c) for c in pages.columns if c.lower() not in ("host", "path", "rule", "verdict", "judged_")]
    parsed = pages.select(*kept, url_host(F.col(url)).alias("host"), url_path(F.col(url)).alias("path"))
    judged = parsed.withColumn("judged_", judge_urls(spark, F.col("host"), F.col("path"), rules, default))
    return judged.select(*[F.col(c) for c in parsed.columns], "judged_.rule", "judged_.verdict")


#: The rules of the query: verdict, host, path.
RULES = [("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"), ("allow", "org", "/fr/")]

SQL = """WITH parsed AS (
  SELECT page_id, translate(regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(coalesce(url, ''), '(?s)^.*?://[^/?#]*([^?#]*)', 1) AS path FROM pages),
rules(verdict, rule_host, rule_path) AS (VALUES ('block', 'net', '/'), ('allow', 'example.net', '/en/'), ('block', 'example.com', '/de/'), ('allow', 'org', '/fr/')),
judged AS (SELECT p.page_id, p.host, p.path, r.rule_host || r.rule_path AS rule, r.verdict,
    row_number() OVER (PARTITION BY p.page_id ORDER BY length(r.rule_host || r.rule_path) DESC) AS k
  FROM parsed p LEFT JOIN rules r ON (p.host = r.rule_host OR ends_with(p.host, '.' || r.rule_host)) AND starts_with(p.path, r.rule_path))
SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict FROM judged WHERE k = 1"""


@register("op4_url_rules", SQL)
def op4_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = read_table(spark, sf_dir, "pages")
    return filter_urls(pages.select("page_id", "url"), RULES).select("page_id", "host", "path", "rule", "verdict")
