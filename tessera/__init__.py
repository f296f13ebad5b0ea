"""tessera: data-quality, drift and model-evaluation operators on Spark DataFrames."""

__version__ = "0.1.0"
