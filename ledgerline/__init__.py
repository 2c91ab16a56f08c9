"""Bronze / silver / gold event tables for payment, login and system-log streams, on PySpark."""
