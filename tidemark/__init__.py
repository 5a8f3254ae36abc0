"""Event-time behaviour analytics on PySpark."""
