"""Mobile-trace analytics on Spark DataFrames.

Itineraries (cities visited per phone, overall and per day) from location
logs and a cell-tower directory, range lookups over them, and a region
classifier from coordinates.
"""

__version__ = "0.1.0"
