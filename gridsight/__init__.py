"""Electric-utility analytics as Spark jobs: extracts, star schema, features, evaluation."""
