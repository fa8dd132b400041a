"""Declared-schema readers for the retail jobs' raw files.

No schema inference (it costs an extra pass over the data and drifts between
file copies).  Delimited files are read against a declared schema; with
``validate_header`` the header line of every file is checked against the
expected names through an alias map, and columns are taken by name.  Malformed rows are kept as NULL-filled rows in PERMISSIVE mode and
counted through the corrupt-record column.
"""

from __future__ import annotations

from collections.abc import Mapping
from contextlib import contextmanager
from functools import reduce
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

CORRUPT = "_corrupt_record"

ITEMS_SCHEMA = T.StructType([
    T.StructField("i_item_id", T.LongType()),
    T.StructField("i_name", T.StringType()),
    T.StructField("i_category_id", T.IntegerType()),
    T.StructField("i_category_name", T.StringType()),
    T.StructField("i_price", T.DoubleType()),
    T.StructField("i_comp_price", T.DoubleType()),
    T.StructField("i_class_id", T.IntegerType()),
])

# Header names seen in copies of the items file, mapped to the
# declared column names (same data rows under both headers).
ITEMS_HEADER_ALIASES = {
    "i_item_name": "i_name",
    "price_1": "i_price",
    "price_2": "i_comp_price",
    "quantity": "i_class_id",
}

STORE_SALES_SCHEMA = T.StructType([
    T.StructField("ss_transaction_id", T.LongType()),
    T.StructField("ss_customer_id", T.LongType()),
    T.StructField("ss_item_id", T.LongType()),
])

REVIEWS_SCHEMA = T.StructType([
    T.StructField("pr_review_id", T.LongType()),
    T.StructField("pr_rating", T.IntegerType()),
    T.StructField("pr_content", T.StringType()),
])

CLICKS_SCHEMA = T.StructType([
    T.StructField("wl_id", T.LongType()),
    T.StructField("wl_customer_id", T.LongType()),
    T.StructField("wl_item_id", T.LongType()),
    T.StructField("wl_webpage_name", T.StringType()),
    T.StructField("wl_timestamp", T.StringType()),
])


def _with_corrupt(schema: T.StructType) -> T.StructType:
    return T.StructType(list(schema.fields) + [T.StructField(CORRUPT, T.StringType())])


def file_headers(spark: SparkSession, path) -> DataFrame:
    """(file, header): the first line of every data file below ``path`` (a folder, file, glob, or list of them);
    empty files have none.

    One job, whatever the number of files: each split of a file is a task of its own (the cost
    of opening a file is set to a whole split), which sends the first row of its first
    batch if the split begins the file, and reads no further.
    """
    def first_line(batches):
        for b in batches:
            if b.num_rows:
                if b.column(2)[0].as_py() == 0:
                    yield b.slice(0, 1).select([0, 1])
                return

    lines = spark.read.option("recursiveFileLookup", True).text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("value").alias("header"), F.col("_metadata.file_block_start").alias("start"))
    return lines.mapInArrow(first_line, "file string, header string")


@contextmanager
def _file_by_file(spark: SparkSession):
    """Scans run inside have one file split a task."""
    name = "spark.sql.files.openCostInBytes"
    old = spark.conf.get(name)
    spark.conf.set(name, spark.conf.get("spark.sql.files.maxPartitionBytes"))
    try:
        yield
    finally:
        spark.conf.set(name, old)


def header_names(line: str, schema: T.StructType, sep: str, aliases: Mapping[str, str] | None) -> tuple[str, ...]:
    """The schema's names in the order of a header line; raises if they differ."""
    names = [h.strip() for h in line.lstrip("\ufeff").rstrip("\r").split(sep)]
    mapped = tuple((aliases or {}).get(h, h) for h in names)
    if sorted(mapped) != sorted(schema.fieldNames()):
        raise ValueError(f"header {names} does not match {schema.fieldNames()}")
    return mapped


#: Different header lines of one read; more are taken for files of another kind.
MAX_HEADERS = 1000


def check_header(spark: SparkSession, path, schema: T.StructType,
                 sep: str = "|", aliases: Mapping[str, str] | None = None) -> dict[tuple[str, ...], list[str]]:
    """Files by the order of their columns; raises if any file's header does not
    have exactly the schema's names (through ``aliases``).  The driver gets the distinct headers, and the names
    of the files only where these stand for more than one order."""
    with _file_by_file(spark):
        headers = file_headers(spark, path)
        lines = [r["header"] for r in headers.select("header").distinct().limit(MAX_HEADERS + 1).collect()]
        if len(lines) > MAX_HEADERS:
            raise ValueError(f"more than {MAX_HEADERS} different header lines")
        orders = {line: header_names(line, schema, sep, aliases) for line in sorted(lines)}
        if len(set(orders.values())) <= 1:
            return {order: [path] if isinstance(path, str) else list(path) for order in orders.values()}
        out: dict[tuple[str, ...], list[str]] = {}
        for r in sorted(headers.collect()):
            out.setdefault(orders[r["header"]], []).append(unquote(r["file"]))
    return out


def read_delimited(spark: SparkSession, path: str, schema: T.StructType, *,
                   sep: str = "|", header: bool = True,
                   aliases: Mapping[str, str] | None = None,
                   validate_header: bool = False,
                   keep_corrupt: bool = False) -> DataFrame:
    """``|``-separated file(s) with a header line, read against ``schema``.

    With ``validate_header`` every file's header is read first, in one job; files whose columns
    stand in another order are read in that order and then rearranged by name.
    Without it columns are taken by position.  CRLF line ends are handled by the CSV
    reader.  With ``keep_corrupt`` the result carries ``_corrupt_record``
    (non-NULL for malformed lines).
    """
    def read(paths, fields: T.StructType) -> DataFrame:
        r = (spark.read.option("sep", sep).option("header", header).option("recursiveFileLookup", validate_header)
             .option("mode", "PERMISSIVE").option("enforceSchema", True))
        if keep_corrupt:
            r = r.option("columnNameOfCorruptRecord", CORRUPT).schema(_with_corrupt(fields))
        else:
            r = r.schema(fields)
        return r.csv(paths)

    if not (validate_header and header):
        return read(path, schema)
    groups = check_header(spark, path, schema, sep, aliases)
    names = schema.fieldNames() + ([CORRUPT] if keep_corrupt else [])
    parts = [read(files, T.StructType([schema[n] for n in order])).select(*names) for order, files in sorted(groups.items())]
    return reduce(DataFrame.unionByName, parts) if parts else read(path, schema)


def read_json_lines(spark: SparkSession, path: str, schema: T.StructType, *,
                    keep_corrupt: bool = False) -> DataFrame:
    """JSON lines against a declared schema: keys not in the schema are not
    parsed, a missing key reads as NULL."""
    r = spark.read.option("mode", "PERMISSIVE")
    if keep_corrupt:
        r = r.option("columnNameOfCorruptRecord", CORRUPT).schema(_with_corrupt(schema))
    else:
        r = r.schema(schema)
    return r.json(path)


def corrupt_count(df: DataFrame) -> DataFrame:
    """(n_rows, n_corrupt) of a frame read with ``keep_corrupt=True``.

    One pass, nothing cached: Spark refuses to read the corrupt column alone, and
    prunes columns that are not read, so the pass takes a hash over all of them.
    The counts are built row by row, which keeps the columns in the scan.
    """
    others = [c for c in df.columns if c != CORRUPT]
    bad = F.when(F.col(CORRUPT).isNotNull(), F.lit(1)).otherwise(F.lit(0))
    # adding 0 * hash uses every column without changing the count
    row = F.pmod(F.xxhash64(*others), F.lit(1))
    return df.agg(F.count(F.lit(1)).alias("n_rows"), F.coalesce(F.sum(bad + row), F.lit(0)).cast("long").alias("n_corrupt"))


def extract_json_fields(df: DataFrame, text_col: str, fields: Mapping[str, str]) -> DataFrame:
    """Add one column per JSON path of a text column: {new_col: '$.path'}."""
    out = df
    for name, p in fields.items():
        out = out.withColumn(name, F.get_json_object(F.col(text_col), p))
    return out
