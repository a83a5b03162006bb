"""DataFrame operators: lazy ``DataFrame -> DataFrame`` functions with column names as parameters."""
