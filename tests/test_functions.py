import hashlib
import struct
import zlib

import pytest
from pyspark.sql import functions as F

from vaultflow.functions import guards
from vaultflow.functions import keys as k
from vaultflow.functions import measures as m
from vaultflow.functions import paths as p


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first()["x"]


@pytest.mark.parametrize("t", [(1, 2, 3), (-1, 2, 3), (0, 0, 0), (2**63 - 1, -(2**63), 7)])
def test_idempotency_key(spark, t):
    got = one(spark, k.idempotency_key(*map(F.lit, t)))
    assert got == hashlib.sha256(struct.pack(">qqq", *t)).hexdigest()
    if t == (1, 2, 3):
        assert got == "ca73761ddabfffcbe51170be0b07f67bafcdbed202545c60707573d36dc935b4"
    if t == (-1, 2, 3):
        assert got == "59d12a5d892cb5a0ad76b8524d723d90e9500e901b4511f21bad57f928a55d47"
    assert one(spark, k.parse_key(F.lit(got.upper()))) == bytes.fromhex(got)


def test_keys_that_are_none(spark):
    assert one(spark, k.parse_key(F.lit("xyz"))) is None
    with pytest.raises(Exception, match="not a key"):
        one(spark, k.parse_key(F.lit("xyz"), strict=True))
    with pytest.raises(ValueError, match="unknown checksum"):
        k.checksum(F.lit(b""), "crc")


def test_checksums(spark):
    data = F.lit(b"payload")
    for name in ("sha256", "sha1", "sha512", "md5"):
        assert one(spark, k.checksum(data, name)) == hashlib.new(name, b"payload").hexdigest()
    assert one(spark, k.checksum(data, None)) is None
    assert one(spark, k.crc32_hex(F.lit("x"))) == f"{zlib.crc32(b'x'):08x}"
    good = hashlib.sha256(b"payload").hexdigest().upper()
    assert one(spark, k.verify_binary(data, F.lit(7), F.lit(good))) is None
    assert "truncated" in one(spark, k.verify_binary(data, F.lit(8)))
    assert "too long" in one(spark, k.verify_binary(data, F.lit(6)))
    assert "mismatch" in one(spark, k.verify_binary(data, F.lit(7), F.lit("00")))
    assert "missing" in one(spark, k.verify_binary(F.lit(None).cast("binary"), F.lit(7)))
    with pytest.raises(ValueError):
        k.verify_binary(data, None, F.lit("00"), None)
    with pytest.raises(ValueError):
        k.verify_binary(data, buffer_size=100)


@pytest.mark.parametrize(("title", "ext", "want"), [
    ('bad/name\\here:*?"<>|', "pdf", "bad_name_here_______.pdf"), ("with\0null", "txt", "withnull.txt"), ("CON", "pdf", "_CON.pdf"), ("lpt3", "pdf", "_lpt3.pdf"), ("trailing dots...   ", "pdf", "trailing dots.pdf"),
    ("", "pdf", "untitled.pdf"), (None, "pdf", "untitled.pdf"), ("Invoice", "", "Invoice.bin"), ("café", "txt", "café.txt"), ("a", "t x t", "a.txt"), ("a", ".DocX", "a.docx"), ("a", "weird!", "a.weird"), ("...", None, "untitled.bin"),
])
def test_sanitize(spark, title, ext, want):
    assert one(spark, p.sanitize(F.lit(title).cast("string"), F.lit(ext).cast("string"))) == want


@pytest.mark.parametrize("end", ["\x85", "\u2028", "\u2029"])
def test_dots_before_a_last_line_separator_stay(spark, end):
    """As in SQL, only the very end is trimmed; a last separator is none of it."""
    assert one(spark, p.sanitize(F.lit("a. " + end), F.lit("txt"))) == f"a. {end}.txt"
    assert one(spark, p.path_title(F.lit("a.." + end))) == f"a..{end}"


def test_reserved_names_in_any_case(spark):
    assert one(spark, p.sanitize(F.lit("con"), F.lit("es"))) == "_con.es" and one(spark, p.sanitize(F.lit("Aux."), F.lit("fr"))) == "_Aux.fr"


def test_sanitize_length_and_change(spark):
    got = one(spark, p.sanitize(F.lit("x" * 100), F.lit("pdf"), 20))
    assert len(got) == 20 and got.endswith(".pdf")
    assert one(spark, p.was_sanitized(F.lit("Invoice"), F.lit("pdf"))) is False
    assert one(spark, p.was_sanitized(F.lit("Invoice"), F.lit("PDF"))) is True
    assert one(spark, p.was_sanitized(F.lit("Inv?oice"), F.lit("pdf"))) is True
    assert one(spark, p.path_title(F.lit("  .a/b. "))) == "a_b"
    assert one(spark, p.path_title(F.lit(""))) == "untitled"
    assert len(one(spark, p.path_title(F.lit("y" * 300)))) == 96


def test_folders(spark):
    key = F.lit("abcd" + "0" * 60)
    assert one(spark, p.folder_hash(key, 3)) == "ab/cd/00" and one(spark, p.folder_flat()) == ""
    for part, n in ((-3, 1000), (0, 1000), (2**63 - 1, 512)):
        assert 0 <= int(one(spark, p.folder_numeric(F.lit(part), n))) < n
    at = F.lit("2026-08-07 10:00:00").cast("timestamp_ntz")
    assert one(spark, p.folder_date(at)) == "2026/08" and one(spark, p.folder_shard_date(key, at)).count("/") == 3
    none = F.lit(None).cast("string")
    for category, ext, want in ((None, "pdf", "pdfs"), ("invoice", "pdf", "invoices"), ("  ", "pdf", "misc"), (None, None, "misc"), ("News", "x", "news"), ("a/b", "x", "abs")):
        assert one(spark, p.folder_category(none if category is None else F.lit(category), none if ext is None else F.lit(ext))) == want
    for bad in (lambda: p.folder_hash(key, 5), lambda: p.folder_numeric(F.lit(1), 0), lambda: p.folder_date(at, " "), lambda: p.output_path("/r", key, depth=0)):
        with pytest.raises(ValueError):
            bad()


def test_paths(spark):
    key = F.lit("abcd" + "0" * 60)
    assert one(spark, p.output_path("/r/", key, F.lit("T/t"), F.lit(".PDF"))) == f"/r/ab/cd/abcd{'0' * 60}__T_t.pdf"
    assert one(spark, p.output_path("/r", key, F.lit(" "), F.lit(""), 1)) == f"/r/ab/abcd{'0' * 60}"
    assert one(spark, p.long_path(F.lit("d/" + "x" * 300 + ".txt"), key)) == "d/abcd000000000000.txt"
    assert one(spark, p.temp_name(F.lit("f.txt"))) == ".f.txt.partial"
    assert one(spark, p.partition_filename(F.lit("a/b:c-d_e.f"))) == "a_b_c-d_e.f"
    for raw, want in (("plain", "plain"), ("a,b", '"a,b"'), ('say "x"', '"say ""x"""'), ("two\nlines", '"two\nlines"'), (None, "")):
        assert one(spark, p.csv_cell(F.lit(raw).cast("string"))) == want
    assert one(spark, p.csv_cell(F.lit("a;b"), ";")) == '"a;b"'
    assert p.quote_identifier("a.b`c") == "`a`.`b``c`"
    with pytest.raises(ValueError):
        p.quote_identifier(" ")


def test_duplicates(spark):
    df = spark.createDataFrame([("a/x.txt", "k1" * 8), ("a/x.txt", "k2" * 8), ("a/x.txt", "k3" * 8), ("b/y", "k4" * 8), ("b/y", "k5" * 8)], "path string, key string")
    got = lambda how: sorted(r["path"] for r in p.resolve_duplicates(df, how).collect())
    assert got("counter") == ["a/x (1).txt", "a/x (2).txt", "a/x.txt", "b/y", "b/y (1)"]
    assert got("hash_suffix") == ["a/x.txt", "a/x_k2k2k2k2.txt", "a/x_k3k3k3k3.txt", "b/y", "b/y_k5k5k5k5"]
    assert sorted(r["key"] for r in p.resolve_duplicates(df, "overwrite").collect()) == ["k3" * 8, "k5" * 8]
    with pytest.raises(Exception, match="path exists"):
        got("fail")
    with pytest.raises(ValueError):
        p.resolve_duplicates(df, "other")


def test_any_number_of_duplicates(spark):
    df = spark.range(10_050).select(F.lit("a/x.txt").alias("path"), F.lpad(F.col("id").cast("string"), 6, "0").alias("key"))
    got = {r["path"] for r in p.resolve_duplicates(df, "counter").collect()}
    assert got == {"a/x.txt", *(f"a/x ({n}).txt" for n in range(1, 10_050))}


def test_rates_and_estimates(spark):
    x = lambda c: one(spark, c)
    at = lambda t: F.lit(t).cast("timestamp_ntz")
    assert x(m.seconds_between(at("2024-01-01 00:00:00.9"), at("2024-01-01 00:00:01.1"))) == 1
    assert x(m.elapsed_hms(F.lit(90_061))) == "01:01:01" and x(m.elapsed_dhms(F.lit(90_061))) == "1.01:01:01"
    assert str(x(m.elapsed_hours(F.lit(522)))) == "0.15"
    assert x(m.docs_per_second(F.lit(10), F.lit(0.0))) == 0 and x(m.docs_per_second(F.lit(10), F.lit(4.0))) == 2.5
    assert str(x(m.percent(F.lit(1), F.lit(3)))) == "33.33" and x(m.percent(F.lit(1), F.lit(0))) is None and x(m.percent(F.lit(1), F.lit(None).cast("int"))) is None
    assert x(m.eta_linear(F.lit(100), F.lit(50), F.lit(10.0))) == 10 and x(m.eta_linear(F.lit(100), F.lit(0), F.lit(10.0))) is None and x(m.eta_linear(F.lit(100), F.lit(100), F.lit(10.0))) == 0
    assert x(m.eta_by_rate(F.lit(100), F.lit(40), F.lit(7.0))) == 8 and x(m.eta_by_rate(F.lit(100), F.lit(40), F.lit(0.0))) is None
    for n, want in ((512, "512 B"), (2048, "2 KiB"), (5 * 2**20, "5.0 MiB"), (3 * 2**30, "3.00 GiB"), (2**41, "2.00 TiB")):
        assert x(m.format_bytes(F.lit(n).cast("bigint"))) == want
    assert [x(m.backoff(F.lit(n), 1, 30)) for n in (0, 1, 2, 3, 6, 99)] == [1, 1, 2, 4, 30, 30]
    assert x(m.backoff(F.lit(1), 10, 30, 0.2, F.lit(0.0))) == pytest.approx(8) and x(m.backoff(F.lit(1), 10, 30, 0.2, F.lit(1.0))) == pytest.approx(12)
    assert x(m.clamped_percent(F.lit(300), F.lit(200))) == 100 and x(m.utilization(F.lit(1), F.lit(0))) == 0 and x(m.queue_ratio(F.lit(1), F.lit(0))) is None


@pytest.mark.parametrize(("kind", "code", "message", "inner", "want"), [
    ("SqlException", 1205, None, None, "SqlDeadlock"), ("SqlException", -2, None, None, "SqlTimeout"), ("SqlException", 40197, None, None, "RateLimited"), ("SqlException", 5, None, None, "Unknown"),
    ("SqlException", 18456, None, None, "PermissionDenied"), ("SqlException", 4060, None, None, "SqlTransient"), ("OperationCanceledException", None, None, None, "Cancelled"), ("TimeoutException", None, None, None, "SqlTimeout"),
    ("SocketException", 10060, None, None, "SqlTimeout"), ("SocketException", 10054, None, None, "NetworkInterruption"), ("SocketException", 10013, None, None, "PermissionDenied"), ("IOException", 28, None, None, "DiskFull"),
    ("IOException", 13, None, None, "PermissionDenied"), ("IOException", 0, "There is NOT ENOUGH space", None, "DiskFull"), ("IOException", 0, "odd", None, "IoFailure"), ("Win32Exception", 112, None, None, "DiskFull"),
    ("ArgumentException", None, None, None, "Permanent"), ("AggregateException", None, None, "TimeoutException", "SqlTimeout"), ("Other", None, None, None, "Unknown"),
])
def test_failures(spark, kind, code, message, inner, want):
    lit = lambda v, t: F.lit(v).cast(t)
    assert one(spark, m.failure_category(F.lit(kind), lit(code, "int"), lit(message, "string"), lit(inner, "string"))) == want


def test_two_classifiers_differ(spark):
    assert one(spark, m.is_retryable(m.failure_category(F.lit("SqlException"), F.lit(64)))) and not one(spark, m.is_transient_sql(F.lit(64)))


def test_guards():
    for bad in (
        lambda: guards.claim(1, 1, 0, 300), lambda: guards.claim(1, 1, 10_001, 300), lambda: guards.claim(1, 1, 5, 3601), lambda: guards.claim(0, 1, 5, 300), lambda: guards.complete(1, "t", "", "c", 1),
        lambda: guards.complete(1, "t", "p", "c", -1), lambda: guards.fail(1, "t", " ", 5), lambda: guards.fail(1, "t", "r", 3601), lambda: guards.renew(1, "t", 0), lambda: guards.start_job("a", "b", "c", "d", -1),
        lambda: guards.complete_job(1, "Paused"), lambda: guards.register(1, "w", "m", "p", 257), lambda: guards.heartbeat(1, "Stopped"), lambda: guards.checkpoint(1, ""), lambda: guards.resolve(1, "New", "me"),
        lambda: guards.within("page_size", 49), lambda: guards.within("shard_depth", 5),
    ):
        with pytest.raises(ValueError):
            bad()
    guards.claim(1, 1, 10_000, 3600)
    guards.start_job("a", "b", "c", "d", None)
