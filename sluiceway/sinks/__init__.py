"""Writers: partitioned files, delimited files, catalog tables and relational databases."""
