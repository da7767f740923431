"""fernwood: Spark-native feature preparation and classifier evaluation for labelled event tables."""

__version__ = "0.1.0"
