from ledgerlens.sources.tables import Tables, read_table  # noqa: F401
