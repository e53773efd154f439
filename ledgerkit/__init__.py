"""ledgerkit: declarative ingest, profiling and integrity checks for delimited exports, on Spark."""

from ledgerkit.spec import ColumnSpec, Dialect, JobConfig, ParentLink, TableSpec

__all__ = ["ColumnSpec", "Dialect", "JobConfig", "ParentLink", "TableSpec"]
