"""zonehour: zone-hour taxi demand with hourly weather, on Spark DataFrames.

Subpackages:
  functions  column builders (built-in expressions only)
  sources    scans, contracts, sinks, and adapters from the test tables
  operators  DataFrame -> DataFrame transforms (cleaning, features, models, profiles)
  plans      composite jobs and the query catalogue with its SQL oracle
  streaming  the cleaning steps as incremental file-stream jobs
"""

from zonehour.config import Config, ForecastSpec, ScaleSpec, TripSpec, WeatherSpec

__all__ = ["Config", "ForecastSpec", "ScaleSpec", "TripSpec", "WeatherSpec"]
