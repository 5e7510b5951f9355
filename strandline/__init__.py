"""strandline: declarative segment-analytics pipelines on Spark DataFrames."""
