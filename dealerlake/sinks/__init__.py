from dealerlake.sinks.records import Record
from dealerlake.sinks.tables import REJECTED, Run, TableStore

__all__ = ["REJECTED", "Record", "Run", "TableStore"]
