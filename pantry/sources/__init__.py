"""Readers and writers: the driver's parquet tables, the fixture views over them,
CSV / JSON / incremental readers and the dataset sinks."""
