from tidewatch.sources.tables import read_table, read_events
from tidewatch.sources.loglines import request_log_lines, file_log_lines, severity_log_rows
from tidewatch.sources.messages import lines_from

__all__ = ["read_table", "read_events", "request_log_lines", "file_log_lines", "severity_log_rows", "lines_from"]
