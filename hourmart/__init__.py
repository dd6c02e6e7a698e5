"""hourmart: hourly energy-market warehouse and analytics on Spark."""

__version__ = "0.1.0"
