"""verdant: keyed time-series cleaning, forecasting and control on Spark."""

__version__ = "0.1.0"
