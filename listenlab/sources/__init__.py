"""Sources and sinks: schemas, JSON events, cleaned Parquet, tables of the test driver."""
