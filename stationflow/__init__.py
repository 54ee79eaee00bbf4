"""PySpark operators and batch plans for moving monitoring-network data between schemas."""
