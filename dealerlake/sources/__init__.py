from dealerlake.sources.address_files import address_file_path, read_address_file, write_address_file
from dealerlake.sources.jdbc import read_jdbc_table, write_jdbc_table
from dealerlake.sources.run_date import resolve_run_date
from dealerlake.sources.staging import created_on, laid_out, rejects

__all__ = [
    "address_file_path",
    "created_on",
    "laid_out",
    "read_address_file",
    "read_jdbc_table",
    "rejects",
    "resolve_run_date",
    "write_address_file",
    "write_jdbc_table",
]
