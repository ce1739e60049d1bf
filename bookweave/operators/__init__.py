"""Order-book operators: DataFrames in, DataFrames out."""
