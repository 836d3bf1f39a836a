"""vigia: case-surveillance analytics on Spark DataFrames."""
