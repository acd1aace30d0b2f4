"""custmaster: insurance customer master datasets as Spark DataFrame jobs."""

__version__ = "0.1.0"
