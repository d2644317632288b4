"""Window statistics, engine comparison and alarm attribution for greenhouse sensors, on Spark."""

__version__ = "0.1.0"
