"""crewspark — team-formation analytics as Spark DataFrame jobs.

Every public function takes DataFrames (and a SparkSession where it must
read or write) and returns a DataFrame; jobs that several steps read are written first.  Nothing builds its own
session; nothing collects tables to the driver.
"""

__version__ = "0.1.0"
