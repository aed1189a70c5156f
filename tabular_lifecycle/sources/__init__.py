from .census_csv import CENSUS_COLUMNS, CENSUS_SCHEMA, read_csv
from .run_log import RUN_LOG_SCHEMA, read_run_log
from .tables import local_rows, read_parquet, read_table

__all__ = [
    "CENSUS_COLUMNS", "CENSUS_SCHEMA", "RUN_LOG_SCHEMA",
    "local_rows", "read_csv", "read_parquet", "read_run_log", "read_table",
]
