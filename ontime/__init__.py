"""On-time performance analytics for scheduled flights, expressed as Spark DataFrame jobs."""
