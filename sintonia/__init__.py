"""sintonia: television audience measurement (Rating % / Share %) on Spark."""

__version__ = "0.1.0"
