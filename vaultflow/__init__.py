"""A PySpark-native engine for document-vault export and its operational analytics."""
