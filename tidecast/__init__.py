"""Balance forecasting and analytics as Spark jobs."""
