"""Rating-prediction analytics on Spark DataFrames.

``sources``    reading and writing rating tables
``functions``  column expressions shared by the operators
``operators``  profiling, sampling, effect fitting, tuning, scoring
``plans``      the operators wired into whole pipelines and named queries
"""
