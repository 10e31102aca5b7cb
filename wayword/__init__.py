"""Word counting, road graphs and post sentiment as PySpark DataFrame jobs."""
