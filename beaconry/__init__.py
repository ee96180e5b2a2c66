"""Server-monitoring warehouse and alerting on PySpark."""
