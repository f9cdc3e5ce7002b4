"""qoelens: connection-quality scoring for home networks, written as Spark jobs."""
