"""Shop-clickstream analytics as Spark DataFrame operators, jobs and streams."""
