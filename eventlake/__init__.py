"""A PySpark-native event lakehouse: bronze, silver, gold, serving queries and operations."""
