"""Vehicle-trip analytics as functions over Spark DataFrames and Columns."""
