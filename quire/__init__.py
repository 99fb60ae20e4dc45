"""quire: document analytics on Spark DataFrames.

Sub-packages: ``sources`` (readers and sinks), ``functions`` (column
expressions), ``operators`` (DataFrame -> DataFrame), ``plans`` (the named
queries with their SQL), ``streaming`` (Structured Streaming extension) and
``llm`` (training-data operators, optional).
"""
