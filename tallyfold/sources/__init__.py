"""Named datasets: where tables are read from and written to."""
