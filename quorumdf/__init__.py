"""Civic-records analytics and corpus preparation as PySpark DataFrame jobs."""
