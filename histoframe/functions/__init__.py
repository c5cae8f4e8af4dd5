"""Column functions: every entry maps Columns to a Column."""
