"""Sources and sinks: driver tables, fixture views, named-query catalogue,
file scans (CSV, SpreadsheetML, sheet exports) and writers."""
