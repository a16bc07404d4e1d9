"""Engines outside Spark: page recognition, models, judges. Each family is a function of a DataFrame; the library brings stubs only."""
