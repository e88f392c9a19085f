"""Reports, table functions, load jobs, quality checks and access filters over
relational star schemas, written as functions from DataFrames to DataFrames."""
