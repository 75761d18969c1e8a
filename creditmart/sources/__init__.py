"""Reading raw files and reading or writing layer tables."""
