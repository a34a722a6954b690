"""framewright: a PySpark engine for time-coded media text."""
