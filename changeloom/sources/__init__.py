"""Reading and writing logs, tables and run results."""
