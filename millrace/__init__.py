"""millrace: captured web pages and post feeds to clean, deduplicated data sets, on Spark DataFrames."""
