"""Layered retail lakehouse analytics as plain Spark jobs.

Every public function takes DataFrames (plus scalar parameters such as an
``as_of`` date) and returns a DataFrame, so callers decide where tables live,
when a plan runs and how results are stored.
"""
