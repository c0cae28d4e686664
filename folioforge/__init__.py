"""A PySpark-native engine for building and analysing corpora of archived web documents."""
