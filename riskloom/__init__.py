"""Riskloom: policy-portfolio analytics as PySpark DataFrame pipelines.

Every operator takes DataFrames and returns a DataFrame; nothing is collected on
the driver and no Python code runs inside tasks.
"""

__version__ = "0.1.0"
