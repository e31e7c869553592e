"""tidemill: table and stream operators and named analytics queries on PySpark.

Every operator is a function from DataFrame(s) to a DataFrame built from
``pyspark.sql`` expressions, so Catalyst plans the shuffles, pushes filters
into the Parquet scan and keeps the work inside whole-stage codegen.
"""

__version__ = "0.1.0"
