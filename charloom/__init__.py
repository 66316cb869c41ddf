"""Character-level corpus building, next-character modelling and scoring on Spark DataFrames."""
