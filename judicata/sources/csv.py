"""Tolerant CSV scan (SRC-1) with drifting columns across files (SRC-2).

The whole of every file decides its encoding (UTF-8 with or without BOM where
every line is valid, else Latin-1, which never fails) in one distributed pass
over the raw lines; the same pass finds the files in which a quoted field holds
a line break (a line with an odd number of quotes).  The first bytes give the
header, which may itself hold quoted line breaks, and the separator (sniffed among
``, ; | tab``).  Files are grouped by (encoding, separator, multi-line, header) and
each group is read once by Spark's CSV source as all-string columns, doubled quotes
being one quote; groups are combined with ``unionByName(allowMissingColumns=True)``.
Files with line breaks in fields are split like all others: their records are
assembled over the splits (:mod:`judicata.sources.records`).  A file that cannot be
read, or whose last quoted field never ends, is reported and skipped, not fatal.
"""

from __future__ import annotations

import csv as _csv
import io
import re
import sys
from urllib.parse import unquote, urlparse

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from judicata.sources.records import assemble_records, parse_records

HEAD_BYTES = 64 * 1024
SEPARATORS = ",;|\t"


def _hadoop_paths(spark: SparkSession, paths):
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    out = []
    for p in paths:
        hp = jvm.org.apache.hadoop.fs.Path(p)
        fs = hp.getFileSystem(conf)
        stats = fs.globStatus(hp)
        for st in (stats or []):
            if st.isFile():
                out.append(st.getPath().toString())
    return sorted(set(out))


def read_head(spark: SparkSession, path: str, n: int = HEAD_BYTES) -> bytes:
    """First ``n`` bytes of a file through the Hadoop FileSystem (any scheme)."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    hp = jvm.org.apache.hadoop.fs.Path(path)
    stream = hp.getFileSystem(conf).open(hp)
    try:
        return bytes(stream.readNBytes(n))
    finally:
        stream.close()


def scan_files(spark: SparkSession, files: list[str]) -> dict[str, tuple[str, bool, bool]]:
    """(encoding, has quoted line breaks, ends inside a quoted field) of every file with a line, from all its bytes."""
    line = F.col("value")
    quotes = F.octet_length(line) - F.octet_length(F.replace(line, F.lit('"')))
    seen = (spark.read.option("lineSep", "\n").text(files).groupBy(F.col("_metadata.file_path").alias("path"))
            .agg(F.bool_and(F.is_valid_utf8(line)).alias("utf8"), F.bool_or(quotes % 2 == 1).alias("multi"),
                 (F.sum(quotes) % 2 == 1).alias("open")))
    return {r.path: ("UTF-8" if r.utf8 else "ISO-8859-1", r.multi, r.open) for r in seen.collect()}     # one row per file


def read_records(spark: SparkSession, files: list[str], enc: str, sep: str, header: tuple[str, ...], skip: int) -> DataFrame:
    """Files with line breaks in quoted fields, their splits read in parallel, as columns ``_c0``, ``_c1``, ...;
    ``skip``: records up to and with the header."""
    raw = spark.read.option("lineSep", "\n").text(files)
    line = F.col("value") if enc == "UTF-8" else F.decode(F.col("value").cast("binary"), "ISO-8859-1")
    lines = raw.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
                       F.monotonically_increasing_id().alias("n"), line.alias("line"))
    records = assemble_records(lines).where(F.col("record_no") > skip)
    return parse_records(records, [f"_c{i}" for i in range(len(header))], sep)


def _first_record(text: str) -> tuple[str, int] | None:
    """The first record that is not blank and the number of lines up to it; None if it goes on beyond ``text``."""
    blank, at = 0, 0
    while at < len(text):
        end = at
        while True:
            end = text.find("\n", end)
            if end < 0 or text.count('"', at, end) % 2 == 0:
                break
            end += 1
        if end < 0:
            return None
        if text[at:end].strip():
            return text[at:end].rstrip("\r"), blank
        blank, at = blank + 1, end + 1
    return None


def sniff(head: bytes, enc: str, whole: bool = True) -> tuple[str, list[str], int] | None:
    """(separator, header, records to skip) from a file head; None if the header goes on beyond it."""
    head = head.removeprefix(b"\xef\xbb\xbf")
    text = head.decode("utf-8" if enc == "UTF-8" else "latin-1", errors="ignore")
    if "\n" not in text:
        text = text.replace("\r", "\n")
    first = _first_record(text + "\n" if whole else text)
    if first is None:
        return None if not whole else (",", [], 0)
    record, blank = first
    lines = [ln for ln in text.splitlines() if ln.strip()][:20]
    sample = "\n".join(lines)
    try:
        sep = _csv.Sniffer().sniff(sample, delimiters=SEPARATORS).delimiter
    except _csv.Error:
        counts = {s: record.count(s) for s in SEPARATORS}
        sep = max(counts, key=counts.get) if any(counts.values()) else ","
    _csv.field_size_limit(sys.maxsize)
    header = next(_csv.reader(io.StringIO(record, newline=""), delimiter=sep))
    return sep, [re.sub(r"\s+", " ", h).strip() for h in header], blank + 1


def head_of(spark: SparkSession, path: str, enc: str) -> tuple[str, list[str], int]:
    """:func:`sniff` of a file, with as much of it as its header needs."""
    n = HEAD_BYTES
    while True:
        head = read_head(spark, path, n)
        got = sniff(head, enc, whole=len(head) < n)
        if got is not None:
            return got
        n *= 4


def read_csv_smart(spark: SparkSession, paths, with_path: bool = True):
    """Returns (DataFrame of all-string columns, list of (path, error) skipped)."""
    files = _hadoop_paths(spark, [paths] if isinstance(paths, str) else paths)
    groups: dict[tuple, list[str]] = {}
    errors = []
    scanned = {unquote(urlparse(p).path): v for p, v in scan_files(spark, files).items()} if files else {}

    def probe(f):
        try:
            enc, multi, unclosed = scanned.get(urlparse(f).path, ("UTF-8", False, False))
            if unclosed:
                raise ValueError("a quoted field does not end")
            sep, header, skip = head_of(spark, f, enc)
            if not header:
                raise ValueError("empty file")
            return f, (enc, sep, multi, tuple(header), skip if multi else 0), None
        except Exception as e:  # noqa: BLE001  (an unreadable file is skipped, not fatal)
            return f, None, f"{type(e).__name__}: {e}"

    # heads are small, independent reads: issue them concurrently (I/O bound)
    from concurrent.futures import ThreadPoolExecutor
    with ThreadPoolExecutor(max_workers=min(32, max(1, len(files)))) as pool:
        for f, key, err in pool.map(probe, files):
            if err is None:
                groups.setdefault(key, []).append(f)
            else:
                errors.append((f, err))
    out = None
    for (enc, sep, multi, header, skip), fs in sorted(groups.items()):
        schema = T.StructType([T.StructField(f"_c{i}", T.StringType()) for i in range(len(header))])
        if multi:
            df, path = read_records(spark, fs, enc, sep, header, skip), F.col("file")
        else:
            df = (spark.read.schema(schema).option("header", True).option("encoding", enc).option("sep", sep)
                  .option("escape", '"').option("mode", "PERMISSIVE").csv(fs))
            path = F.col("_metadata.file_path")
        cols = [F.col(f"_c{i}").alias(h.strip() or f"_c{i}") for i, h in enumerate(header)]
        if with_path:
            cols.append(path.alias("_source_file"))
        df = df.select(*cols)
        out = df if out is None else out.unionByName(df, allowMissingColumns=True)
    return out, errors
