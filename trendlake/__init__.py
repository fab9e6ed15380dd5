"""trendlake: daily content lakes on Spark.

Every public function takes DataFrames (or Columns) and returns DataFrames
(or Columns); nothing pulls table data to the driver.
"""

__version__ = "0.1.0"
