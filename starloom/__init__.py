"""Star-schema batch analytics on PySpark: small functions from DataFrame to DataFrame."""
