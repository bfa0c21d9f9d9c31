"""leadspark: a PySpark-native engine for business-record data."""
