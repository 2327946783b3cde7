"""Build and score repository-level code benchmarks as Spark table jobs.

Every operator is a plain function ``op(df, ...) -> df``: it declares a plan and
starts no job.  See the README for the list of operators and the layout.
"""

__version__ = "0.1.0"
