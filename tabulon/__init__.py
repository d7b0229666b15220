"""tabulon: Spark-first operators over evidence-backed statistical tables."""
