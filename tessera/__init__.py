"""tessera: cleaning, aligning and reconciling periodic tables on Spark."""

__version__ = "0.1.0"
