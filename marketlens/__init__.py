"""Job-market ETL and analytics as Spark DataFrame operators."""
