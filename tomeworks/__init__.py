"""Text-corpus features and classification as set-based Spark jobs."""
