"""Record qualification and delivery as Spark jobs over user-supplied tables."""

__version__ = "0.1.0"
