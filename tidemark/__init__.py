"""Usage analytics on Spark: log reports, popularity scores, live windows and models."""
