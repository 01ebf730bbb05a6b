"""File sources and sinks: CSV / text / JSON / XML / binary scans with explicit
schemas.

All paths are expected to be on storage every executor sees (the shared
folder from ``quarry.session.shared_dir``), never a machine-local temp dir.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def string_schema(*names: str) -> T.StructType:
    return T.StructType([T.StructField(n, T.StringType(), True) for n in names])


def double_schema(*names: str) -> T.StructType:
    return T.StructType([T.StructField(n, T.DoubleType(), True) for n in names])


def write_csv(df: DataFrame, path: str, header: bool = True, sep: str = ",",
              compression: str | None = None) -> str:
    w = df.write.mode("overwrite").option("header", header).option("sep", sep)
    if compression:
        w = w.option("compression", compression)
    w.csv(path)
    return path


def read_csv(spark: SparkSession, path: str, schema: T.StructType, header: bool = True,
             sep: str = ",", null_value: str | None = None) -> DataFrame:
    """CSV scan with an explicit schema (never inferSchema)."""
    r = spark.read.schema(schema).option("header", header).option("sep", sep)
    if null_value is not None:
        r = r.option("nullValue", null_value)
    return r.csv(path)


def write_lines(lines: DataFrame, path: str, compression: str | None = None) -> str:
    """Write a one-string-column DataFrame as text files, one line per row."""
    w = lines.write.mode("overwrite")
    if compression:
        w = w.option("compression", compression)
    w.text(path)
    return path


def read_lines(spark: SparkSession, path: str, whole_text: bool = False) -> DataFrame:
    """Line scan (``value`` column); ``whole_text`` gives one row per file."""
    return spark.read.text(path, wholetext=whole_text)


def drop_header_lines(lines: DataFrame, marker: str = '"') -> DataFrame:
    """Drop header lines anywhere in the data: a line containing the marker."""
    return lines.where(~F.col("value").contains(marker))


def read_json(spark: SparkSession, path: str, schema: T.StructType,
              multiline: bool = False) -> DataFrame:
    return spark.read.schema(schema).option("multiLine", multiline).json(path)


def write_xml(df: DataFrame, path: str, row_tag: str, root_tag: str,
              compression: str | None = None, max_records: int = 0) -> str:
    """Write one element per row; ``max_records`` bounds the elements of a file."""
    w = (df.write.mode("overwrite").format("xml")
         .option("rowTag", row_tag).option("rootTag", root_tag).option("maxRecordsPerFile", max_records))
    if compression:
        w = w.option("compression", compression)
    w.save(path)
    return path


def read_xml(spark: SparkSession, path: str, row_tag: str, schema: T.StructType) -> DataFrame:
    """One row per ``row_tag`` element (child of the root); gzip read transparently."""
    return spark.read.format("xml").option("rowTag", row_tag).schema(schema).load(path)


def elements(text: str, tag: str):
    """The ``tag`` elements of an XML text, each as a text of its own (elements
    of one tag do not nest; entities are those of XML itself)."""
    return F.regexp_extract_all(F.col(text), F.lit(rf"(?s)<{tag}(?:\s[^>]*)?(?<!/)>.*?</{tag}\s*>"), 0)


def element_groups(found, n: int = 200, root: str = "group"):
    """An array of elements as texts of at most ``n`` of them under a root."""
    size = F.size(found)
    return F.when(size > 0, F.transform(F.sequence(F.lit(0), size - 1, F.lit(n)), lambda i: F.concat(
        F.lit(f"<{root}>"), F.array_join(F.slice(found, i + 1, n), ""), F.lit(f"</{root}>"))))


def read_binary(spark: SparkSession, path: str, glob: str | None = None) -> DataFrame:
    """binaryFile scan: path, modificationTime, length, content."""
    r = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    if glob:
        r = r.option("pathGlobFilter", glob)
    return r.load(path)
