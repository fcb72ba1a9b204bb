"""Event-feed cleaning and sales analytics as plain functions over Spark DataFrames."""
