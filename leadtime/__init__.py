"""Hours-to-fault analytics for equipment fleets on Spark DataFrames."""
