"""Quality analytics for utility-meter readings, written as Spark DataFrame jobs."""
