"""A PySpark-native engine that mines labelled figure records from documents."""
