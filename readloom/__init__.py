"""Quality control and expression analytics over sequencing runs, on Spark."""

__version__ = "0.1.0"
