"""Writing tables to files and databases."""
