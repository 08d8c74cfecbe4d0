"""platework: registration analytics as Spark DataFrames."""
