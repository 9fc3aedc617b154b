"""Line scans of corrupt text dumps (SRC-6) and zip members (SRC-7, SRC-8)."""

from __future__ import annotations

import io
import re
import zipfile

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def read_latin1_lines(spark: SparkSession, paths, header_prefix: str | None = None, skip_header: bool = False) -> DataFrame:
    """Byte lines decoded as ISO-8859-1; only ``\\n`` ends a line (a ``\\r`` inside
    a record stays in the line).  The text source keeps the raw bytes, which are
    re-decoded as Latin-1; the header line is dropped by its content, or with
    ``skip_header`` by its place: it is the first line of the split that begins a file."""
    df = spark.read.option("lineSep", "\n").text(paths)
    line = F.decode(F.col("value").cast("binary"), "ISO-8859-1")
    cols = [line.alias("line"), F.col("_metadata.file_path").alias("_source_file")]
    out = df.select(*cols)
    if skip_header:
        placed = df.select(*cols, F.col("_metadata.file_block_start").alias("_start"), F.monotonically_increasing_id().alias("_n"))
        first = placed.where("_start = 0").groupBy(F.col("_source_file").alias("_file")).agg(F.min("_n").alias("_first"))    # a row a file
        kept = placed.join(first, F.col("_source_file") == F.col("_file"), "left")
        out = kept.where((F.col("_start") != 0) | (F.col("_n") != F.col("_first"))).select("line", "_source_file")
    if header_prefix is not None:
        out = out.where(~F.col("line").startswith(header_prefix))
    return out


def _repair_name(info: zipfile.ZipInfo) -> str:
    """Member names without the UTF-8 flag were decoded as cp437; re-decode them."""
    if info.flag_bits & 0x800:
        return info.filename
    raw = info.filename.encode("cp437")
    for enc in ("utf-8", "latin-1"):
        try:
            return raw.decode(enc)
        except UnicodeDecodeError:
            continue
    return info.filename


ZIP_LINES = T.StructType([T.StructField("zip_path", T.StringType()), T.StructField("member", T.StringType()),
                          T.StructField("line_no", T.LongType()), T.StructField("line", T.StringType())])


def read_zip_lines(spark: SparkSession, paths, include: str = r".*", exclude: str | None = None) -> DataFrame:
    """Lines of the zip members whose (repaired) name matches ``include`` and not
    ``exclude`` (samples, dictionaries).  A zip is not splittable, so each archive
    is one task; members are streamed line by line, never materialised whole."""
    bins = spark.read.format("binaryFile").load(paths).select("path", "content")
    inc = re.compile(include, re.I)
    exc = re.compile(exclude, re.I) if exclude else None

    def expand(batches):
        for pdf in batches:
            for path, content in zip(pdf["path"], pdf["content"]):
                with zipfile.ZipFile(io.BytesIO(content)) as zf:
                    for info in zf.infolist():
                        name = _repair_name(info)
                        if info.is_dir() or not inc.search(name) or (exc and exc.search(name)):
                            continue
                        rows = []
                        with zf.open(info) as fh:
                            for i, raw in enumerate(fh):
                                rows.append((path, name, i, raw.rstrip(b"\n").decode("latin-1")))
                                if len(rows) >= 10_000:
                                    yield pd.DataFrame(rows, columns=ZIP_LINES.names)
                                    rows = []
                        if rows:
                            yield pd.DataFrame(rows, columns=ZIP_LINES.names)

    return bins.mapInPandas(expand, ZIP_LINES)
