"""lacuna — gap completion for station time series, expressed as Spark DataFrame operators.

Every public operator takes a DataFrame (plus column names) and returns a DataFrame.
Nothing is collected to the driver; series are partitioned by station.
"""

__version__ = "0.1.0"
