"""Build and maintain a dimensional warehouse with plain Spark DataFrames."""
