"""tidesift: sentiment analytics over tables and streams of short texts, on Spark DataFrames."""
