"""Language-model data tables on Spark: DataFrames in, DataFrames out."""
