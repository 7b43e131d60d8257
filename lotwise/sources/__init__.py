"""Where tables are read from and where results are written to."""
