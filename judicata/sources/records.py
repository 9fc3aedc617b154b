"""Records of delimited text whose quoted fields may hold line breaks, assembled in parallel (SRC-1).

A line ends a record only where the quotes before its end, from the start of its
file, are even in number.  Lines come in blocks (file splits).  Of every block one
pass over the quote counts alone gives its parity and how many of its lines would
begin a record if the block began outside a quoted field, and if it began inside
one.  A prefix sum over the blocks of a file then says which of the two holds and
how many records begin before the block, so each block numbers its own records and
the pieces of a record that crosses blocks carry the same number.  Only first and
last pieces of blocks are put together across blocks; a file of any size is read by all tasks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from judicata.session import materialise


def _odd(line: str) -> Column:
    return (F.octet_length(line) - F.octet_length(F.replace(F.col(line), F.lit('"')))) % 2


def _joined(rows: Column, field: str) -> Column:
    return F.array_join(F.transform(F.array_sort(F.collect_list(rows)), lambda r: r[field]), "\n")


def assemble_records(lines: DataFrame, file: str = "file", block: str = "block", order: str = "n", line: str = "line") -> DataFrame:
    """(file, record_no, record) from lines in order of (block, order) within their file; numbers start at 1.

    A record keeps its inner line breaks and loses a carriage return at its end.
    Quotes that never close make one record of all that follows: see
    :func:`unclosed_files`."""
    x = lines.select(F.col(file).alias("file"), F.col(block).alias("block"), F.col(order).alias("n"), F.col(line).alias("line"))
    before = Window.partitionBy("file", "block").orderBy("n").rowsBetween(Window.unboundedPreceding, -1)
    upto = Window.partitionBy("file", "block").orderBy("n").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    inside = F.coalesce(F.sum("odd").over(before), F.lit(0)) % 2            # as seen from the start of the block
    sizes = (x.select("file", "block", "n", _odd("line").alias("odd")).withColumn("inside", inside).groupBy("file", "block")
             .agg((F.sum("odd") % 2).alias("parity"), F.count_if(F.col("inside") == 0).alias("out"), F.count_if(F.col("inside") == 1).alias("within")))
    earlier = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)     # a row a block
    blocks = (sizes.withColumn("start", F.coalesce(F.sum("parity").over(earlier), F.lit(0)) % 2)
              .withColumn("opens", F.when(F.col("start") == 0, F.col("out")).otherwise(F.col("within")))
              .withColumn("first", F.coalesce(F.sum("opens").over(earlier), F.lit(0))).select("file", "block", "start", "opens", "first"))
    y = x.join(blocks, ["file", "block"]).withColumn("odd", _odd("line"))
    y = y.withColumn("begins", ((F.col("start") + inside) % 2 == 0).cast("int"))
    y = y.withColumn("record_no", F.col("first") + F.sum("begins").over(upto))
    edge = (F.col("record_no") == F.col("first")) | (F.col("record_no") == F.col("first") + F.col("opens"))
    pieces = materialise(y.withColumn("edge", edge).groupBy("file", "block", "record_no", "edge")
                         .agg(_joined(F.struct("n", "line"), "line").alias("piece")))
    whole = pieces.where("NOT edge").select("file", "record_no", F.col("piece").alias("record"))
    cut = pieces.where("edge").groupBy("file", "record_no").agg(_joined(F.struct("block", "piece"), "piece").alias("record"))
    out = whole.unionByName(cut)
    return out.withColumn("record", F.when(F.endswith("record", F.lit("\r")), F.expr("left(record, char_length(record) - 1)")).otherwise(F.col("record")))


def unclosed_files(lines: DataFrame, file: str = "file", line: str = "line") -> DataFrame:
    """(file): files with an odd number of quotes, in which the last quoted field never ends."""
    return lines.groupBy(F.col(file).alias("file")).agg((F.sum(_odd(line)) % 2).alias("odd")).where("odd = 1").select("file")


def decode_lines(lines: DataFrame, file: str = "file", raw: str = "raw", line: str = "line") -> DataFrame:
    """Byte lines as text: a file is UTF-8 if all its lines are, else Latin-1, which never fails."""
    text = F.col(raw).cast("string")
    utf8 = lines.groupBy(F.col(file).alias("_file")).agg(F.bool_and(F.is_valid_utf8(text)).alias("_utf8"))
    joined = lines.join(utf8, F.col(file).eqNullSafe(F.col("_file")))
    return joined.withColumn(line, F.when(F.col("_utf8"), text).otherwise(F.decode(F.col(raw), "ISO-8859-1"))).drop("_file", "_utf8", raw)


def parse_records(records: DataFrame, columns: list[str], sep: str, record: str = "record", keep_empty: bool = False) -> DataFrame:
    """Fields of every record as text, doubled quotes being one; all other columns are kept.

    Empty fields are null, as in Spark's own reader; with ``keep_empty`` quoted ones are empty texts."""
    schema = ", ".join(f"_c{i} string" for i in range(len(columns)))
    parsed = F.from_csv(F.col(record), schema, {"sep": sep, "escape": '"', "multiLine": "true", "mode": "PERMISSIVE",
                                                  **({"nullValue": "\u0000"} if keep_empty else {})})
    keep = [c for c in records.columns if c != record]
    out = records.where(F.trim(record) != "").withColumn("_fields", parsed)
    return out.select(*keep, *[F.col(f"_fields._c{i}").alias(c) for i, c in enumerate(columns)])
