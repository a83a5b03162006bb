"""Column functions: every one takes and returns ``Column`` and stays inside generated code."""
