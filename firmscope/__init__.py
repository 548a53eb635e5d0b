"""A PySpark-native engine that scores and monitors firms from collected evidence."""
