"""Text-to-knowledge-graph and corpus analytics on PySpark."""
