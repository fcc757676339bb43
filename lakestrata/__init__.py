"""Layered lake analytics on Spark: raw -> bronze -> silver -> gold -> answers.

Every function takes and returns DataFrames or Columns; nothing here starts a
session, collects rows to the driver, or turns ANSI mode off.
"""
