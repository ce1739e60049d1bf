"""Order books, their statistics and their validation as Spark DataFrames."""
