"""Sources and sinks: parquet tables, reference-shaped adapters, declared
schema readers for delimited and JSON-lines files, and result sinks."""

from aisleflow.sources.tables import table  # noqa: F401
from aisleflow.sources import adapters  # noqa: F401
