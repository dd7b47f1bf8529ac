"""tickflow: trade-stream analytics as plain PySpark DataFrame functions.

Every operator takes and returns DataFrames. The same function serves batch
and Structured Streaming unless its docstring says otherwise.
"""
