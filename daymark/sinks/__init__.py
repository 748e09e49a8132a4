from daymark.sinks.csv import write_csv_indexed
from daymark.sinks.tables import by_start_date, publish_version, replace_table, swap_table

__all__ = ["by_start_date", "publish_version", "replace_table", "swap_table", "write_csv_indexed"]
