"""gridlore: indicator analytics written as PySpark DataFrame jobs."""
