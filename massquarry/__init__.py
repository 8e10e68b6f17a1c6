"""massquarry: spectral retrieval analytics and data preparation on PySpark DataFrames."""
