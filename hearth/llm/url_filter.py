"""URL filter on a sorted digest array.

Rules are (host, path prefix, verdict).  The sorted 64-bit xxhash keys of
``host + path`` and the rule strings are written once, shipped to the executors
with ``addFile`` and memory-mapped there, so the Python workers of a machine
share one copy.  A URL's probes are its host suffixes at label bounds times
the prefixes of its path whose lengths occur among the rules; a batch's probes
are looked up by one vectorised binary search, and the stored full string
confirms every hit against hash collisions.

Large rule sets are cut into blocks of bounded size that are probed in turn;
each block keeps the longest rule so far, so memory does not grow with the
rules.
"""

from __future__ import annotations

import os
import re
import tempfile
from collections.abc import Iterable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import SparkFiles
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Rules per memory-mapped file: about 100 MB at 80 bytes a rule.
RULES_PER_BLOCK = 1_000_000
_SPLIT = re.compile(r"://([^/?#]*)([^?#]*)", re.S)
_FOLD = str.maketrans({chr(c): chr(c + 32) for c in range(0x41, 0x5B)})


@dataclass(frozen=True)
class Rule:
    host: str
    path: str
    verdict: str  # allow or block

    @property
    def text(self) -> str:
        return self.host + self.path


def host_and_path(url: str | None) -> tuple[str, str]:
    """Host: after the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z
    lower-cased.  Path: from there up to ``?``, ``#`` or the end.  A null url or
    one without ``://`` has both empty."""
    if not url or (at := url.find("://")) < 0:
        return "", ""
    m = _SPLIT.match(url, at)
    return m[1].translate(_FOLD), m[2]


class DigestArray:
    """Sorted keys, and the strings they stand for, mapped from one file."""

    def __init__(self, path: str):
        with open(path, "rb") as f:
            n, n_lengths = np.frombuffer(f.read(16), np.int64)
        part = lambda at, kind, size: np.memmap(path, kind, "r", at, (int(size),)) if size else np.zeros(0, kind)
        at = 16
        self.keys = part(at, np.uint64, n)
        self.starts = part(at := at + 8 * int(n), np.int64, n + 1)
        self.verdicts = part(at := at + 8 * int(n + 1), np.uint8, n)
        self.host_len = part(at := at + int(n), np.uint32, n)
        self.lengths = part(at := at + 4 * int(n), np.int64, n_lengths)
        size = os.path.getsize(path) - (at := at + 8 * int(n_lengths))
        self.strings = part(at, np.uint8, size)

    @staticmethod
    def write(rules: Iterable[Rule], path: str) -> None:
        """Of equal (host, path) rules, block wins over allow."""
        best: dict[tuple[str, str], str] = {}
        for r in rules:
            key = (r.host.translate(_FOLD), r.path)
            best[key] = "block" if "block" in (best.get(key), r.verdict) else r.verdict
        rows = sorted((xxhash.xxh64_intdigest((h + p).encode()), h, p, v) for (h, p), v in best.items())
        texts = [(h + p).encode() for _, h, p, _ in rows]
        lengths = sorted({len(p) for _, _, p, _ in rows})
        with open(path, "wb") as f:
            f.write(np.array([len(rows), len(lengths)], np.int64).tobytes())
            f.write(np.array([k for k, *_ in rows], np.uint64).tobytes())
            f.write(np.concatenate([[0], np.cumsum([len(t) for t in texts], dtype=np.int64)]).astype(np.int64).tobytes())
            f.write(np.array([v == "allow" for *_, v in rows], np.uint8).tobytes())
            f.write(np.array([len(h.encode()) for _, h, _, _ in rows], np.uint32).tobytes())
            f.write(np.array(lengths, np.int64).tobytes())
            f.write(b"".join(texts))

    def best(self, urls: list[str | None]) -> list[tuple[str, str, str | None, int, bool]]:
        """Per url: host, path, longest fitting rule or None, its host's bytes,
        allow.  Longest by the rule's text; of equal texts the longer host."""
        split = [host_and_path(u) for u in urls]
        owner, probe, host_len = [], [], []
        lengths = self.lengths.tolist()
        longest = int(self.host_len.max()) if len(self.host_len) else 0
        for i, (host, path) in enumerate(split):
            suffix = host
            if len(host) > longest:  # no rule fits a longer suffix
                dot = host.find(".", len(host) - longest - 1)
                suffix = host[dot + 1 :] if dot >= 0 else ""
            while suffix:
                size = len(suffix.encode())
                for n in lengths:
                    if n <= len(path):
                        owner.append(i)
                        probe.append((suffix + path[:n]).encode())
                        host_len.append(size)
                suffix = suffix.partition(".")[2]
        out = [(h, p, None, 0, False) for h, p in split]
        if not probe or not len(self.keys):
            return out
        want = np.fromiter((xxhash.xxh64_intdigest(x) for x in probe), np.uint64, len(probe))
        lo = np.searchsorted(self.keys, want, side="left")
        hit = lo < len(self.keys)
        hit[hit] = self.keys[lo[hit]] == want[hit]
        for j in np.flatnonzero(hit).tolist():
            k = int(lo[j])
            while k < len(self.keys) and self.keys[k] == want[j]:  # all rules of this digest
                text = self.strings[self.starts[k] : self.starts[k + 1]].tobytes()
                if text == probe[j] and int(self.host_len[k]) == host_len[j]:
                    host, path, old, old_host, _ = out[owner[j]]
                    rule = text.decode()
                    if old is None or (len(rule), host_len[j]) > (len(old), old_host):
                        out[owner[j]] = (host, path, rule, host_len[j], bool(self.verdicts[k]))
                k += 1
        return out


_MAPPED: dict[str, DigestArray] = {}


def _ship(df: DataFrame, rules: list[Rule]) -> str:
    """The rules' file, named by its contents, on every executor."""
    folder = os.path.realpath(tempfile.mkdtemp(prefix="url-rules-"))  # the driver's own; addFile serves it to the executors
    draft = os.path.join(folder, "draft")
    DigestArray.write(rules, draft)
    with open(draft, "rb") as f:
        name = f"url-rules-{xxhash.xxh64_hexdigest(f.read())}.bin"
    os.rename(draft, os.path.join(folder, name))
    sc = df.sparkSession.sparkContext
    if not any(x.endswith("/" + name) for x in sc.listFiles):
        sc.addFile(os.path.join(folder, name))
    return name


def judge(df: DataFrame, rules: Iterable[Rule], url_col: str = "url", default: str = "allow",
          rules_per_block: int = RULES_PER_BLOCK) -> DataFrame:
    """``df`` plus host, path, rule (text of the longest fitting rule, or null)
    and verdict (that rule's, else ``default``: what no rule lists passes).

    A rule fits its host and all subdomains, if the path starts with the
    rule's.  Null urls, empty hosts and empty rule sets give no rule; rows are
    judged each by itself; existing columns of the four names are replaced."""
    added = ("host", "path", "rule", "verdict")
    fields = [f for f in df.schema.fields if f.name not in added or f.name == url_col]
    keep = [f.name for f in fields if f.name not in added]
    work = T.StructType(
        [f for f in fields if f.name in keep]
        + [T.StructField(n, t) for n, t in (("__host", T.StringType()), ("__path", T.StringType()), ("__rule", T.StringType()),
                                            ("__size", T.LongType()), ("__allow", T.BooleanType()))]
    )
    rules = list(rules)
    out = df.select(*[F.col(f"`{c}`") for c in keep])
    for at in range(0, max(1, len(rules)), rules_per_block):
        out = out.mapInArrow(_probe(_ship(df, rules[at : at + rules_per_block]), url_col, keep, work, at == 0), work)
    verdict = F.when(F.col("__rule").isNull(), F.lit(default)).when(F.col("__allow"), "allow").otherwise("block")
    return out.select(
        *[F.col(f"`{c}`") for c in keep], F.col("__host").alias("host"), F.col("__path").alias("path"),
        F.col("__rule").alias("rule"), verdict.alias("verdict"),
    )


def _probe(name, url_col, keep, schema, first):
    def run(batches):
        if name not in _MAPPED:
            _MAPPED[name] = DigestArray(SparkFiles.get(name))
        index = _MAPPED[name]
        for batch in batches:
            rows = index.best(batch.column(url_col).to_pylist())
            if not first:
                for i, (rule, size, allow) in enumerate(
                    zip(*(batch.column(c).to_pylist() for c in ("__rule", "__size", "__allow")), strict=True)
                ):
                    if rule is not None and (rows[i][2] is None or (len(rule), size) > (len(rows[i][2]), rows[i][3])):
                        rows[i] = (*rows[i][:2], rule, size, allow)
            cols = list(zip(*rows, strict=True)) if rows else [[]] * 5
            kinds = (pa.string(), pa.string(), pa.string(), pa.int64(), pa.bool_())
            yield pa.RecordBatch.from_arrays(
                [batch.column(c) for c in keep] + [pa.array(list(c), k) for c, k in zip(cols, kinds, strict=True)],
                names=schema.names,
            )

    return run
