"""spliceloom: transcript-structure analytics as Spark DataFrame jobs."""
