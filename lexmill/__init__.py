"""lexmill: DataFrame-to-DataFrame operators for large legal-document corpora on Spark."""

__version__ = "0.1.0"
