"""millrace: DataFrame-to-DataFrame operators for curating web crawls on Spark."""

__version__ = "0.1.0"
