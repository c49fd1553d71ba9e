"""bramble: Spark-native analytics operators for retail sales, web clickstream and
subscription tables.

Every operator takes DataFrames (plus column names / parameters) and returns one lazy
DataFrame. The heavy work always runs as Spark joins, aggregates, windows and
shuffles; nothing is collected to the driver.
"""

__version__ = "0.1.0"
