"""The write-ahead record of a partition's cursor: one line, replaced as a whole."""

from __future__ import annotations

import os
import re
import zlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vaultflow.functions.keys import parse_wal


def wal_path(root: str, partition: str) -> str:
    return f"{root.rstrip('/')}/{re.sub(r'[^\w.-]', '_', partition)}.wal"


def write_wal(root: str, partition: str, part: int, ver: int, docs: int, at: str) -> str:
    """at: ISO time with milliseconds and Z. The line is written beside, flushed, and renamed."""
    body = f"{part}|{ver}|{docs}|{at}"
    path = wal_path(root, partition)
    os.makedirs(root, exist_ok=True)
    temp = f"{path}.partial"
    with open(temp, "w", encoding="utf-8") as f:
        f.write(f"{body}|{zlib.crc32(body.encode()):08x}\n")
        f.flush()
        os.fsync(f.fileno())
    os.replace(temp, path)
    return path


def put_wal(spark: SparkSession, root: str, partition: str, part: int, ver: int, docs: int, at: str) -> str:
    """write_wal on any file system that Hadoop knows: the line is written beside and renamed over the old one."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    fs, path = jvm.org.apache.hadoop.fs, wal_path(root, partition)
    body = f"{part}|{ver}|{docs}|{at}"
    temp, target = fs.Path(f"{path}.partial"), fs.Path(path)
    out = temp.getFileSystem(conf).create(temp, True)
    out.write(f"{body}|{zlib.crc32(body.encode()):08x}\n".encode())
    out.hsync()
    out.close()
    over = spark.sparkContext._gateway.new_array(fs.Options.Rename, 1)
    over[0] = fs.Options.Rename.OVERWRITE
    fs.FileContext.getFileContext(temp.getFileSystem(conf).getUri(), conf).rename(temp, target, over)
    return path


def read_wal(spark: SparkSession, path: str) -> DataFrame:
    """file, last_part, last_ver, processed, at: of each file the last line that is not blank; files whose line is not whole give no row."""
    lines = spark.read.text(path, wholetext=True).select(F.col("_metadata.file_name").alias("file"), F.split("value", "\\r?\\n").alias("lines"))
    last = lines.select("file", F.try_element_at(F.filter("lines", lambda x: F.trim(x) != ""), F.lit(-1)).alias("line")).filter("line IS NOT NULL")
    return last.select("file", parse_wal("line").alias("w")).filter("w IS NOT NULL").select("file", "w.*")
