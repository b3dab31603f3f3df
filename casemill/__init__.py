"""casemill: case intake, topic classification and reporting as Spark jobs."""
