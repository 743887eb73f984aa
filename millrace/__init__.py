"""millrace: streaming and batch order analytics, written as plain Spark jobs."""
