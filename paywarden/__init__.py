"""Transaction quality and fraud analytics as Spark DataFrame operators.

Every operator takes and returns a DataFrame (or a Column), so the same code
serves batch tables and streams.
"""
