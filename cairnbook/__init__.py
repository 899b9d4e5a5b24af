"""cairnbook: incident records from news pages, as Spark DataFrame jobs."""
