"""Lake zones, KPI tables and risk scoring as plain Spark DataFrame jobs."""
