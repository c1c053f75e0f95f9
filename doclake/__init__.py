"""doclake: landing, cleaning and auditing of captured documents as Spark DataFrame jobs."""
