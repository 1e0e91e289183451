"""WARC archives: writing with revisit records, and reading by boundary chains.

Writing: payload digests are SHA-1 in base32, computed by SQL functions.  Of
rows with equal payloads the one with the smallest id is a response record and
the others are revisit records that refer to it.  Only rows whose id may be a
revisit (by a bitmap of fixed size) take part in a join; all others go straight
to the archive, so payloads are not shuffled.

Reading: archives are split anywhere.  A task takes every occurrence of the
version line in its split as a candidate record and emits its offset and the
offset of its successor (header and content length).  Chains are shortened
inside a split, pointer jumping over the splits finds what is reachable from
the start of each file, and only reachable records are kept: a version line
inside a payload is never one.  Splits are the unit of memory, not files.
"""

from __future__ import annotations

import base64
import hashlib
import re

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hearth.llm.tables import bit_of, bitmap, maybe_in, saved, shared_path

MAGIC = "WARC/1.1\r\n"
END = "\r\n\r\n"
_HTTP = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "
_HEX32, _B32 = "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"


def sha1_base32(payload: Column) -> Column:
    """Bare upper-case base32 SHA-1: 40 hex digits are four groups of 40 bits,
    each eight base32 digits."""
    digest = F.sha1(payload)
    groups = [F.lpad(F.conv(F.substring(digest, i * 10 + 1, 10), 16, 32), 8, "0") for i in range(4)]
    return F.translate(F.concat(*groups), _HEX32, _B32)


def classify(pages: DataFrame, key: str, payload_col: str, min_bytes: int) -> DataFrame:
    """``key``, ``__payload``, ``__digest``, ``__first`` (the response a revisit
    refers to, else null) and the other columns of ``pages``."""
    rows = pages.withColumn("__payload", F.coalesce(F.col(f"`{payload_col}`").cast("string"), F.lit("")))
    rows = rows.withColumn("__digest", sha1_base32(F.col("__payload"))).withColumn("__n", F.octet_length("__payload").cast("long"))
    ids = rows.select(F.col(key).alias("__id"), "__digest", "__n").where(F.col("__n") >= min_bytes)
    first = ids.groupBy("__digest").agg(F.min("__id").alias("__first"), F.count("*").alias("__rows")).where("__rows > 1")
    again = saved(
        ids.join(first, "__digest").where("__first is not null and not (__id <=> __first)")
        .select(F.col("__id").alias("__key"), F.col("__digest").alias("__key_digest"), "__first").distinct(), "revisits",
    )
    maybe, never = maybe_in(rows.withColumn("__digest_key", F.concat_ws(":", F.col(key).cast("string"), "__digest")),
                            bitmap(again.select(F.concat_ws(":", F.col("__key").cast("string"), "__key_digest").alias("k")), bit_of("k")),
                            "__digest_key")
    joined = maybe.join(again, (F.col(key).eqNullSafe(F.col("__key"))) & (F.col("__digest") == F.col("__key_digest")), "left")
    return joined.drop("__key", "__key_digest").unionByName(never.withColumn("__first", F.lit(None).cast(ids.schema["__id"].dataType)))


def write_archives(pages: DataFrame, path: str, key: str = "page_id", payload_col: str = "html", url_col: str = "url",
                   min_bytes: int = 0) -> None:
    """One WARC record per row under ``path``, uncompressed, one file a task.

    Null payloads are empty; payloads below ``min_bytes`` are always responses;
    rows that repeat the smallest id of their payload are responses as well; a
    null id is never a response that others refer to."""
    keep = pages.select(F.col(key), F.col(payload_col), F.col(url_col).alias("__url"))
    rows = classify(keep, key, payload_col, min_bytes)
    revisit = F.col("__first").isNotNull()
    size = F.col("__n").cast("string")
    http = F.when(revisit, F.lit("")).otherwise(F.concat(F.lit(_HTTP), size, F.lit(END)))
    body = F.when(revisit, F.lit("")).otherwise(F.col("__payload"))
    head = F.concat(
        F.lit(MAGIC + "WARC-Type: "), F.when(revisit, "revisit").otherwise("response"),
        F.coalesce(F.concat(F.lit("\r\nWARC-Record-ID: <urn:page:"), F.col(key).cast("string"), F.lit(">")), F.lit("")),
        F.lit("\r\nWARC-Date: 2024-01-01T00:00:00Z\r\nWARC-Target-URI: "),
        F.regexp_replace(F.coalesce("__url", F.lit("")), "[\r\n]", "%0A"),
        F.lit("\r\nWARC-Payload-Digest: sha1:"), F.col("__digest"), F.lit("\r\nX-Payload-Length: "), size,
        F.when(revisit, F.concat(
            F.lit("\r\nWARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest\r\nWARC-Refers-To: <urn:page:"),
            F.col("__first").cast("string"), F.lit(">"))).otherwise(""),
        F.lit("\r\nContent-Type: application/http; msgtype=response\r\nContent-Length: "),
        (F.octet_length(http) + F.octet_length(body)).cast("string"), F.lit(END),
    )
    rows.select(F.concat(head, http, body).alias("value")).write.option("lineSep", END).text(path)


_FIELD = re.compile(rb"^(WARC-Type|WARC-Record-ID|WARC-Payload-Digest|WARC-Refers-To|X-Payload-Length|Content-Length): *(.*?)\r?$", re.M | re.I)
_URN = re.compile(rb"<urn:page:(.*)>$")
_PIECE = "file string, block long, idx long, at long, piece_end long, next long, exit long, type string, id string, refers string, digest string, bytes long, sha1 string, body long"


def parse_head(piece: bytes) -> tuple[dict[str, bytes], int] | None:
    """Fields and header length of the text after a version line, or None."""
    end = piece.find(END.encode())  # no bound: a header is as long as its URL
    if end < 0:
        return None
    fields = {k.decode().lower(): v for k, v in _FIELD.findall(piece[:end])}
    if not fields.get("content-length", b"").isdigit() or "warc-type" not in fields:
        return None
    return fields, end + 4


def payload_of(block: bytes) -> bytes:
    cut = block.find(END.encode()) if block.startswith(b"HTTP/") else -4
    return block[cut + 4 :] if cut >= 0 else block


def b32(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _pieces(spark: SparkSession, path: str) -> DataFrame:
    """The archive's text between version lines, with the split it is from."""
    return spark.read.option("lineSep", MAGIC).text(path).select(
        F.encode("value", "UTF-8").alias("value"), F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
    )


def _walk(batches):
    """(file, block, index, local offset of the text, text) in archive order."""
    here, idx, at = None, 0, 0
    for b in batches:
        for value, file, block in zip(b.column("value"), b.column("file").to_pylist(), b.column("block").to_pylist(), strict=True):
            if (file, block) != here:
                here, idx, at = (file, block), 0, 0
            piece = value.as_py()
            yield file, block, idx, at, piece
            idx += 1
            at += len(piece) + len(MAGIC)


def _candidates(batches):
    """One row per version line.  ``at``, ``next``, ``exit`` and ``piece_end``
    are offsets from the split's first byte that a task reads; ``exit`` is
    where the chain from the record leaves the split."""
    names = [f.split()[0] for f in _PIECE.split(", ")]

    def flush(rows):
        where = {r["at"]: r for r in rows}
        for r in reversed(rows):
            after = where.get(r["next"])
            r["exit"] = r["next"] if after is None or after is r else after["exit"]
        return pa.RecordBatch.from_pylist(rows, schema=_ARROW)

    rows, here = [], None
    for file, block, idx, at, piece in _walk(batches):
        if here is not None and here != (file, block):
            yield flush(rows)
            rows = []
        here = (file, block)
        row = dict.fromkeys(names) | {"file": file, "block": block, "idx": idx, "at": at - len(MAGIC), "piece_end": at + len(piece) + len(MAGIC)}
        if got := parse_head(piece):
            fields, head = got
            size = int(fields["content-length"])
            row["next"] = at + head + size + len(END)
            urn = {k: m[1].decode() for k in ("warc-record-id", "warc-refers-to") if (m := _URN.search(fields.get(k, b"").strip()))}
            row |= {"type": fields["warc-type"].decode(), "id": urn.get("warc-record-id"), "refers": urn.get("warc-refers-to"),
                    "digest": fields.get("warc-payload-digest", b"").decode().removeprefix("sha1:").strip() or None,
                    "bytes": int(fields["x-payload-length"]) if fields.get("x-payload-length", b"").strip().isdigit() else None}
            if len(piece) >= head + size:
                payload = payload_of(piece[head : head + size])
                row |= {"sha1": b32(payload), "body": len(payload)}
        rows.append(row)
    if rows:
        yield flush(rows)


_ARROW = pa.schema([(f.split()[0], pa.string() if f.split()[1] == "string" else pa.int64()) for f in _PIECE.split(", ")])


def _follow(rows: pd.DataFrame) -> pd.DataFrame:
    """The records of one split that the chain from its entry meets."""
    after = dict(zip(rows["at"], rows["next"], strict=True))
    kept, at = set(), rows.loc[rows["entry"], "at"].min()
    while at in after and at not in kept:
        kept.add(at)
        at = after[at]
    return rows[rows["at"].isin(kept)].drop(columns="entry")


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """The records of all archives under ``path``: file, at (offset), type, id,
    refers, digest (header), bytes (header), sha1 and body (digest and length
    of the payload read back).  No archives or empty files give no rows."""
    found = saved(_pieces(spark, path).mapInArrow(_candidates, _PIECE), "candidates")
    sizes = found.groupBy("file", "block").agg(F.max("piece_end").alias("size"))
    order = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    base = sizes.select("file", "block", F.coalesce(F.sum("size").over(order), F.lit(0)).alias("base"))
    rows = found.join(base, ["file", "block"]).select(
        "file", "block", "idx", *[(F.col(c) + F.col("base")).alias(c) for c in ("at", "piece_end", "next", "exit")],
        "type", "id", "refers", "digest", "bytes", "sha1", "body",
    )
    rows = saved(rows, "offsets")
    records = rows.where("next is not null")
    step = saved(
        records.join(records.select("file", F.col("exit").alias("at")).distinct(), ["file", "at"], "left_semi")
        .unionByName(records.where("at = 0")).select("file", "at", F.col("exit").alias("to")).distinct(), "steps",
    )
    reach, n = saved(step.where("at = 0").select("file", "at"), "reach"), -1
    while (now := reach.count()) != n:  # pointer jumping: each round doubles the distance
        n = now
        reach = saved(reach.unionByName(reach.join(step, ["file", "at"]).select("file", F.col("to").alias("at"))).distinct(), "reach")
        hop = step.select("file", F.col("at").alias("to"), F.col("to").alias("to2"))
        step = saved(step.join(hop, ["file", "to"], "left").select("file", "at", F.coalesce("to2", "to").alias("to")), "steps")
    entries = reach.withColumn("entry", F.lit(True))
    marked = records.join(entries, ["file", "at"], "left").withColumn("entry", F.coalesce("entry", F.lit(False)))
    kept = saved(marked.groupBy("file", "block").applyInPandas(_follow, marked.drop("entry").schema), "records")
    whole = kept.where("sha1 is not null")
    if kept.where("sha1 is null").limit(1).count():
        whole = whole.unionByName(_reassembled(spark, path, rows, kept))
    return whole.select("file", "at", "type", "id", "refers", "digest", "bytes", "sha1", "body")


def _reassembled(spark: SparkSession, path: str, rows: DataFrame, kept: DataFrame) -> DataFrame:
    """Records with a version line inside their payload: their pieces are read
    again and joined; each group is one record."""
    starts = kept.select("file", "at", F.col("at").alias("owner"), F.col("sha1").isNull().alias("open"))
    order = Window.partitionBy("file").orderBy("at")
    parts = rows.join(starts, ["file", "at"], "left").withColumn("owner", F.last("owner", True).over(order)).withColumn(
        "open", F.last("open", True).over(order)
    )
    key = F.concat_ws(":", "file", "block", "idx")
    parts = saved(parts.where("open").select("file", "at", "owner", key.alias("k")), "parts")

    def text(batches):
        for file, block, idx, _, piece in _walk(batches):
            yield pa.RecordBatch.from_arrays([pa.array([f"{file}:{block}:{idx}"]), pa.array([piece], pa.binary())], names=["k", "piece"])

    maybe, _ = maybe_in(_pieces(spark, path).mapInArrow(text, "k string, piece binary"), bitmap(parts, bit_of("k")), "k")

    def join(key, group: pd.DataFrame) -> pd.DataFrame:
        piece = MAGIC.encode().join(group.sort_values("at")["piece"])
        fields, head = parse_head(piece)
        payload = payload_of(piece[head : head + int(fields["content-length"])])
        return pd.DataFrame({"file": [key[0]], "at": [key[1]], "sha1": [b32(payload)], "body": [len(payload)]})

    full = parts.join(maybe, "k").groupBy("file", "owner").applyInPandas(join, "file string, at long, sha1 string, body long")
    return kept.where("sha1 is null").drop("sha1", "body").join(full, ["file", "at"]).select(*kept.columns)


def round_trip(pages: DataFrame, key: str = "page_id", payload_col: str = "html", url_col: str = "url", min_bytes: int = 0) -> DataFrame:
    """Archives of ``pages`` in the shared folder, read back: per record the
    id, payload_bytes, payload_digest, record_type and refers_to."""
    path = shared_path(pages.sparkSession, "warc")
    write_archives(pages, path, key, payload_col, url_col, min_bytes)
    kind = pages.schema[key].dataType
    r = read_records(pages.sparkSession, path)
    response = F.col("type") == "response"
    return r.select(
        F.col("id").cast(kind).alias(key),
        F.when(response, F.col("body")).otherwise(F.col("bytes")).cast(T.LongType()).alias("payload_bytes"),
        F.when(response, F.col("sha1")).otherwise(F.col("digest")).alias("payload_digest"),
        F.col("type").alias("record_type"), F.col("refers").cast(kind).alias("refers_to"),
    )
