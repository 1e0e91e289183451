import base64
import hashlib
import random

from hearth.llm import warc
from hearth.llm.queries import QUERIES

from llm_data import SF

SCHEMA = "page_id long, url string, html string"


def expected(rows, min_bytes=0):
    first = {}
    for i, _, h in rows:
        p = (h or "").encode()
        if len(p) >= min_bytes and i is not None:
            first[p] = min(first.get(p, i), i)
    out = []
    for i, _, h in rows:
        p = (h or "").encode()
        f = first.get(p)
        again = f is not None and f != i and len(p) >= min_bytes
        out.append((i, len(p), base64.b32encode(hashlib.sha1(p).digest()).decode(), "revisit" if again else "response", f if again else None))
    return sorted(out, key=str)


def got(df):
    return sorted(((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in df.collect()), key=str)


def rows_with_magic(seed, n=60):
    rnd = random.Random(seed)
    fake = "WARC/1.1\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:page:999>\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n"
    parts = [fake, "WARC/1.1\r\n", "WARC/WARC/1.1\r\n", "\r\n\r\n", "é日本", "<p>text</p>", "WARC/1.1\r\nContent-Length: 5\r\n\r\n"]
    rows = [(i, f"http://x/{i}\r\nWARC-Type: hop", "".join(rnd.choice(parts) for _ in range(rnd.randint(0, 6)))) for i in range(n)]
    return rows + [(n, None, None), (n + 1, "u", ""), (n + 2, "u", "x" * 5000), (n + 3, "u", "x" * 5000)]


def test_round_trip_with_magic_in_payloads(spark):
    rows = rows_with_magic(1)
    assert got(warc.round_trip(spark.createDataFrame(rows, SCHEMA).repartition(3))) == expected(rows)


def test_records_cross_splits(spark):
    """Splits far smaller than records: chains and payloads cross many."""
    rows = rows_with_magic(2)
    old = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "700")
        spark.conf.set("spark.sql.files.openCostInBytes", "1")
        assert got(warc.round_trip(spark.createDataFrame(rows, SCHEMA).coalesce(1))) == expected(rows)
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)


def test_minimum_size_ties_and_nulls(spark):
    rows = [(1, "u", "abc"), (2, "u", "abc"), (2, "u", "abc"), (1, "u", "abc"), (3, "u", "ab"), (4, "u", "ab"), (None, "u", "zz"), (7, "u", "zz")]
    assert got(warc.round_trip(spark.createDataFrame(rows, SCHEMA), min_bytes=3)) == expected(rows, 3)


def test_long_urls_at_the_start_and_in_the_middle_of_a_file(spark):
    long = "data:text/html," + "x" * 100_000
    for places in ({0}, {4}, {0, 1, 4, 7}):
        rows = [(i, long if i in places else f"http://x/{i}", f"<p>{i}</p>") for i in range(8)]
        assert got(warc.round_trip(spark.createDataFrame(rows, SCHEMA).coalesce(1))) == expected(rows)


def test_empty_table(spark):
    assert warc.round_trip(spark.createDataFrame([], SCHEMA)).count() == 0


def test_base32_of_sha1(spark):
    from pyspark.sql import functions as F

    rows = [("",), ("abc",), ("é" * 1000,)]
    df = spark.createDataFrame(rows, "t string").select("t", warc.sha1_base32(F.col("t")).alias("d"))
    assert all(r.d == warc.b32(r.t.encode()) for r in df.collect())


def test_op5_equals_plain_version(spark):
    rows = [(r.page_id, r.url, r.html) for r in spark.read.parquet(f"{SF}/pages.parquet").collect()]
    assert got(QUERIES["op5_warc"](spark, SF)) == expected(rows)
