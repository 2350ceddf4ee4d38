from .writers import (append_csv, append_table, checkpoint_table, csv_to_parquet, export_by_year,
                      export_year_ordered, rebalanced_for, repair_years, table_exists,
                      table_schema, verify_years, write_csv, write_parquet)

__all__ = ["append_csv", "append_table", "checkpoint_table", "csv_to_parquet", "export_by_year",
           "export_year_ordered", "rebalanced_for", "repair_years", "table_exists",
           "table_schema", "verify_years", "write_csv", "write_parquet"]
