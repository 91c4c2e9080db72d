"""Ad-campaign analytics as PySpark DataFrame jobs."""
