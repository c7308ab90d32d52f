"""Sources (Parquet, catalog, derived views) and sinks (catalog tables)."""

from .fixtures import FX_SQL, fixture, fixture_cte, fixture_source
from .tables import CatalogSource, DerivedSource, FrameSource, ParquetSource, Source

__all__ = [
    "FX_SQL", "fixture", "fixture_cte", "fixture_source",
    "CatalogSource", "DerivedSource", "FrameSource", "ParquetSource", "Source",
]
