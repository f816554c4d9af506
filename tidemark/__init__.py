"""Event-time behaviour analytics as Spark DataFrame operators and jobs."""
