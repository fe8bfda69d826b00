"""trailmill: clickstream analytics as Spark DataFrame jobs."""
