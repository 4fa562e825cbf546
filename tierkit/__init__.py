"""tierkit: reusable bronze -> silver -> gold operators on the PySpark DataFrame API.

Every operator takes a DataFrame plus column names and returns a DataFrame;
nothing here collects rows to the driver or runs its own execution engine.
"""

__version__ = "0.1.0"
