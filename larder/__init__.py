"""larder: order-sales analytics and demand forecasting as lazy Spark DataFrame operators.

Every public operator takes and returns a ``pyspark.sql.DataFrame`` and is built from
built-in Spark SQL functions, windows, joins and aggregations, so a whole menu of items
is processed in one distributed plan.
"""

__version__ = "0.1.0"
