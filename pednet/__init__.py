"""A PySpark-native analytics engine for pedestrian networks."""
