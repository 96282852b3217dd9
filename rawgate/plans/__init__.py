"""The whole intake as one plan."""
