from playstats.sources.delimited import read_csv, read_tsv
from playstats.sources.files import list_files, read_json_lines, with_source_file
from playstats.sources.tables import scan_table

__all__ = ["list_files", "read_json_lines", "with_source_file", "read_tsv", "read_csv", "scan_table"]
