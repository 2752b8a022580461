"""Column functions: parsing, normalising and scoring product data on the JVM."""
