"""The library run on the benchmark tables, with the SQL each result is checked against."""
