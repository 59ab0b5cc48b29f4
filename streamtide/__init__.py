"""Live-stream analytics on Spark: typed sources, rollups, wide rows, training and scoring.

Every function takes and returns DataFrames or Columns. Nothing here keeps a
session, sets a master or collects a table to the driver.
"""
