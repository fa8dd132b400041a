"""Helpers shared by the training-data operators: table access, the shared
folder, durable cuts of lineage, and shipping of this package to the executors."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from aisleflow.session import ensure_checkpoint_dir

_SHIPPED: set[str] = set()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _scratch(spark: SparkSession) -> str:
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/llm/{spark.sparkContext.applicationId}"


def shared_path(spark: SparkSession, name: str) -> str:
    """A fresh folder below the checkpoint folder, which all executors share."""
    return f"{_scratch(spark)}/{name}-{uuid.uuid4().hex}"


def drop_scratch(spark: SparkSession) -> bool:
    """Delete what the operators of this application wrote below the checkpoint
    folder; call it when none of their results is read any more."""
    path = spark._jvm.org.apache.hadoop.fs.Path(_scratch(spark))
    return path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def cut(df: DataFrame, name: str = "cut") -> DataFrame:
    """Durable cut of lineage: the rows are written as a table to the shared
    checkpoint folder and read back, so each is computed once and losing an
    executor afterwards loses nothing."""
    path = shared_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def ship(spark: SparkSession) -> None:
    """Send this package to the Python workers once per application, so that
    functions used in ``mapInArrow`` can be imported there."""
    app = spark.sparkContext.applicationId
    if app in _SHIPPED:
        return
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    fd, path = tempfile.mkstemp(prefix="aisleflow-", suffix=".zip")
    os.close(fd)
    with zipfile.ZipFile(path, "w") as z:
        for folder, _, files in os.walk(os.path.join(root, "aisleflow")):
            for f in sorted(files):
                if f.endswith(".py"):
                    full = os.path.join(folder, f)
                    z.write(full, os.path.relpath(full, root))
    spark.sparkContext.addPyFile(path)
    _SHIPPED.add(app)


def held_out(doc_id: Column) -> Column:
    """Fold of a document: crc32 of the id as text, modulo 4, is 2.  A null id
    counts as the empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 4 == 2


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z only.  Texts of ASCII characters alone take the fast
    built-in, which there does the same."""
    text = F.coalesce(text, F.lit(""))
    upper = "".join(map(chr, range(65, 91)))
    return F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(
        F.translate(text, upper, upper.lower()))


def binary_values(column) -> list:
    """The values of an Arrow string column as bytes; null stays None."""
    import pyarrow as pa

    return column.cast(pa.binary()).to_pylist()
