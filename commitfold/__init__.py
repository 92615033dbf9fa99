"""Commit-stream analytics on Spark.

Landed commit frames in, `post` / `engagement` tables and their analysis out.
Every public function takes and returns DataFrames (or Columns) and is lazy
unless its docstring says otherwise.
"""
