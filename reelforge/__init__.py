"""Feature engineering and classification of title-like tables, on Spark DataFrames.

Every function takes DataFrames or Columns and returns lazy DataFrames or Columns. The session always
belongs to the caller: nothing here sets a master, a port or a global configuration.
"""
