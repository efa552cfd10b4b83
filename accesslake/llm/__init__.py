"""Training-data operators: near duplicates, quality, packing, token files, language model.

Each module is one operator (a DataFrame in, DataFrames out); ``queries`` binds
them to the given tables.  Nothing outside this subpackage imports it.
"""
