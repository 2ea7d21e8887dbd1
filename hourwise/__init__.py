"""hourwise: hourly demand-series preparation, profiling and forecasting on Spark.

Every operator is a plain function ``DataFrame -> DataFrame`` built from Spark
SQL expressions, joins, windows and Spark ML, working on many keyed series at
once.  Nothing is collected to the driver except one-row sizes where an
operator needs a number (split sizes, sample sizes).
"""

__version__ = "0.1.0"
