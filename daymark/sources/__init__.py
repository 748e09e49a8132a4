from daymark.sources.tables import (
    RESULT_SCHEMA,
    SCHEMAS,
    Tables,
    conform,
    from_catalog,
    from_parquet,
    from_values,
    write_forecasts,
)

__all__ = [
    "RESULT_SCHEMA",
    "SCHEMAS",
    "Tables",
    "conform",
    "from_catalog",
    "from_parquet",
    "from_values",
    "write_forecasts",
]
