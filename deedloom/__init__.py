"""deedloom: Spark-native operators for messy property registers.

Every operator takes and returns lazy DataFrames (or Columns); nothing here
needs a driver-side copy of the data.
"""
