"""Secondary-sales and trade-promotion warehouse operators on Spark DataFrames.

Every operator is a plain function ``DataFrame -> DataFrame``; paths, sessions
and periods are arguments, never notebook state.
"""
