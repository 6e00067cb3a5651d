"""Entity-resolution and analytics engine expressed in Spark DataFrames."""
