"""corvane: a PySpark-native engine for speech-video corpora and training-data pipelines."""

__version__ = "0.1.0"
