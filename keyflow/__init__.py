"""keyflow: a PySpark-native change-data-capture engine for key-value command logs."""
