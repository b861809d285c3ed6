"""Sources and sinks: role tables, JDBC, CSV, reports, model artifacts."""
