"""Sources and sinks: CSV files, catalog tables, fitted models."""
