"""parcelmart: delivery-booking analytics expressed as Spark DataFrame plans.

Sub-packages
------------
sources    reading input tables, deriving stand-in mart sources, writing outputs
functions  Column -> Column helpers (JSON, timestamps, strings, arrays, formatting)
operators  DataFrame -> DataFrame operators (bucketing, top-1 per group, joins, unions)
plans      the booking mart: step functions, the 64-metric catalogue, the runner
streaming  the histogram operator over a file stream
"""

__all__ = ["sources", "functions", "operators", "plans", "streaming"]
