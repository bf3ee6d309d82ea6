from snapmart.sources.csv import read_csv, write_csv  # noqa: F401
from snapmart.sources.tables import (  # noqa: F401
    expire_versions, read_day, read_latest_version, read_table, write_day, write_days, write_version,
)
from snapmart.sources.jsonl import read_json_lines, write_json_lines  # noqa: F401
