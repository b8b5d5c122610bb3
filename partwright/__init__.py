"""partwright — partitioned Parquet export and reconciliation on Spark."""

from .schema import KEYS, SALES_SCHEMA
from .session import build_session, scratch_path, scratch_root

__all__ = ["KEYS", "SALES_SCHEMA", "build_session", "scratch_path", "scratch_root"]
