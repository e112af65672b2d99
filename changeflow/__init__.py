"""changeflow: moving and shaping change data with Spark DataFrames."""
