"""corpusloom: a PySpark-native engine for auditing, repairing and preparing text corpora."""
