"""Column rules: every function here takes and returns Columns."""
