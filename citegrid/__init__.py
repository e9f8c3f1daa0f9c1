"""citegrid — evidence retrieval and answer checking as Spark jobs."""

__version__ = "0.1.0"
