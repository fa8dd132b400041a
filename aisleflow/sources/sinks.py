"""Result sinks: published views/tables, a queryable run log, model files.

Paths default to folders under the session's shared checkpoint location.
"""

from __future__ import annotations

import datetime as _dt
import os
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from aisleflow.session import ensure_checkpoint_dir

RUN_LOG_SCHEMA = T.StructType([
    T.StructField("run_id", T.StringType(), False),
    T.StructField("job", T.StringType(), False),
    T.StructField("kind", T.StringType(), False),      # param | metric
    T.StructField("name", T.StringType(), False),
    T.StructField("value", T.DoubleType()),
    T.StructField("value_text", T.StringType()),
    T.StructField("logged_at", T.TimestampType()),
])


def publish(df: DataFrame, name: str, path: str | None = None) -> DataFrame:
    """Make ``df`` queryable by name; with ``path`` also write it as parquet
    (then the view reads the written files, cutting the lineage)."""
    if path:
        df.write.mode("overwrite").parquet(path)
        df = df.sparkSession.read.parquet(path)
    df.createOrReplaceTempView(name)
    return df


def drop_view(spark: SparkSession, name: str) -> bool:
    """Drop a session temp view; False when it did not exist."""
    return bool(spark.catalog.dropTempView(name))


def run_log_path(spark: SparkSession) -> str:
    return os.path.join(ensure_checkpoint_dir(spark), "run_log")


def param_rows(model_or_estimator) -> list[tuple[str, object]]:
    """(name, value) of every set or defaulted param, from the param map
    itself (never typed in by hand)."""
    out = []
    for p, v in model_or_estimator.extractParamMap().items():
        out.append((p.name, v))
    return sorted(out)


def _row(run_id, job, kind, name, value, now):
    if isinstance(value, bool):
        return (run_id, job, kind, name, float(value), str(value), now)
    if isinstance(value, (int, float)):
        return (run_id, job, kind, name, float(value), None, now)
    return (run_id, job, kind, name, None, str(value), now)


def log_run(spark: SparkSession, job: str, params: dict | list | None = None,
            metrics: dict | None = None, path: str | None = None,
            run_id: str | None = None) -> DataFrame:
    """Append one run's params and metrics to the run log (parquet) and
    return the rows written."""
    run_id = run_id or uuid.uuid4().hex
    now = _dt.datetime.now(_dt.timezone.utc).replace(tzinfo=None)
    items = params.items() if isinstance(params, dict) else (params or [])
    rows = [_row(run_id, job, "param", k, v, now) for k, v in items]
    rows += [_row(run_id, job, "metric", k, v, now) for k, v in (metrics or {}).items()]
    df = spark.createDataFrame(rows, RUN_LOG_SCHEMA)
    df.write.mode("append").parquet(path or run_log_path(spark))
    return df


def read_run_log(spark: SparkSession, path: str | None = None) -> DataFrame:
    return spark.read.schema(RUN_LOG_SCHEMA).parquet(path or run_log_path(spark))


def save_model(model, path: str) -> str:
    """Write any fitted model or pipeline."""
    model.write().overwrite().save(path)
    return path


def load_model(path: str):
    """A saved model or pipeline, of the class that its metadata names."""
    from pyspark.ml.util import DefaultParamsReader
    return DefaultParamsReader.loadParamsInstance(path, SparkSession.active())
