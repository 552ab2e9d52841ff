from playstats.sinks.dml import (append_if_absent, delete_by_key, insert_if_absent, new_rows_if_absent,
                                 replace_contents, upsert)
from playstats.sinks.writers import (conform, create_table, insert_rows, save_bucketed_table, write_csv,
                                     write_table, write_tsv)

__all__ = ["append_if_absent", "new_rows_if_absent", "delete_by_key", "insert_if_absent", "replace_contents", "upsert", "conform",
           "create_table", "insert_rows", "save_bucketed_table", "write_csv", "write_table", "write_tsv"]
