from keelson.sources.files import (  # noqa: F401
    load_model,
    save_model,
    scan_csv,
    scan_parquet,
    write_csv_predictions,
    write_parquet,
    write_report_json,
)
from keelson.sources.tables import TABLES, read_table, table_path  # noqa: F401
