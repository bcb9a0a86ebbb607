"""Tabular credit-risk analytics as Spark jobs.

Every operator takes and returns DataFrames.  Operators that depend on the data first *fit* a small typed spec
(medians, edges, levels, cut keys) with aggregate jobs and then *transform* with a plain projection, so the schema of a
transform is known before it runs.
"""
