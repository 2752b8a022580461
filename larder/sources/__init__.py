"""Reading and writing catalogue files."""
