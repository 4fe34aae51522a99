"""Keys, checksums and the write-ahead record."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from vaultflow.schemas import OUTCOMES


def _col(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def idempotency_key(part, ver, dfv) -> Column:
    """Lowercase hex SHA-256 of three big-endian signed 64-bit numbers."""
    wide = [F.lpad(F.hex(_col(x).cast("long")), 16, "0") for x in (part, ver, dfv)]
    return F.sha2(F.unhex(F.concat(*wide)), 256)


def parse_key(text, strict: bool = False) -> Column:
    """64 hex digits as 32 bytes; others are null, or raise if strict."""
    text = _col(text)
    other = F.raise_error(F.concat(F.lit("not a key: "), F.coalesce(text, F.lit("null")))).cast("binary") if strict else F.lit(None).cast("binary")
    return F.when(text.rlike("^[0-9a-fA-F]{64}$"), F.unhex(text)).otherwise(other)


def shard_prefix(key, nth: int = 0) -> Column:
    """The nth byte of a hex key as two digits."""
    return F.substring(_col(key), 2 * nth + 1, 2)


def checksum(data, algorithm: str | None = "sha256") -> Column:
    data = _col(data)
    known = {"sha256": lambda: F.sha2(data, 256), "sha1": lambda: F.sha1(data), "sha512": lambda: F.sha2(data, 512), "md5": lambda: F.md5(data), "none": lambda: F.lit(None).cast("string")}
    name = (algorithm or "none").lower().replace("-", "")
    if name not in known:
        raise ValueError(f"unknown checksum algorithm: {algorithm}")
    return known[name]()


def crc32_hex(text) -> Column:
    """IEEE CRC-32 as eight lowercase digits."""
    return F.lower(F.lpad(F.hex(F.crc32(_col(text).cast("binary"))), 8, "0"))


def verify_binary(data, expected_length=None, expected_checksum=None, algorithm: str | None = "sha256", buffer_size: int = 81_920) -> Column:
    """Null if the payload is as expected, else what is wrong with it."""
    if expected_checksum is not None and (algorithm or "none").lower() == "none":
        raise ValueError("a checksum is expected, but no algorithm is chosen")
    if buffer_size < 4096:
        raise ValueError("buffer_size must be 4096 or more")
    data = _col(data)
    said = F.when(data.isNull(), F.lit("content is missing"))
    if expected_length is not None:
        n = _col(expected_length)
        said = said.when(F.octet_length(data) < n, F.concat(F.lit("truncated: "), F.octet_length(data), F.lit(" of "), n, F.lit(" bytes")))
        said = said.when(F.octet_length(data) > n, F.concat(F.lit("too long: "), F.octet_length(data), F.lit(" for "), n, F.lit(" bytes")))
    if expected_checksum is not None:
        said = said.when(F.lower(checksum(data, algorithm)) != F.lower(_col(expected_checksum)), F.lit("checksum mismatch"))
    return said.otherwise(F.lit(None).cast("string"))


def iso_ms(t) -> Column:
    return F.date_format(_col(t), "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'")


def wal_line(part, ver, docs, at) -> Column:
    """part|ver|docs|time|crc of what stands before it."""
    body = F.concat_ws("|", _col(part).cast("string"), _col(ver).cast("string"), _col(docs).cast("string"), iso_ms(at))
    return F.concat(body, F.lit("|"), crc32_hex(body))


def parse_wal(line) -> Column:
    """A struct of last_part, last_ver, processed, at; null where the line is not whole."""
    line = _col(line)
    cells = F.split(line, "\\|")
    body = F.regexp_replace(line, "\\|[^|]*$", "")
    values = F.struct(
        F.try_element_at(cells, F.lit(1)).try_cast("long").alias("last_part"), F.try_element_at(cells, F.lit(2)).try_cast("long").alias("last_ver"),
        F.try_element_at(cells, F.lit(3)).try_cast("long").alias("processed"), F.try_to_timestamp(F.try_element_at(cells, F.lit(4)), F.lit("yyyy-MM-dd'T'HH:mm:ss.SSS'Z'")).cast("timestamp_ntz").alias("at"),
    )
    whole = (F.size(cells) == 5) & (F.try_element_at(cells, F.lit(5)) == crc32_hex(body))
    good = values["last_part"].isNotNull() & values["last_ver"].isNotNull() & values["processed"].isNotNull() & values["at"].isNotNull()
    return F.when(whole & good, values)


def outcome_name(status) -> Column:
    names = F.create_map(*(F.lit(x) for i, n in enumerate(OUTCOMES) for x in (i, n)))
    return names[_col(status)]
