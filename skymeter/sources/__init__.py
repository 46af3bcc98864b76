from skymeter.sources.readings import connections_table, read_readings, readings_table, split_malformed
from skymeter.sources.tables import load_table

__all__ = ["connections_table", "load_table", "read_readings", "readings_table", "split_malformed"]
