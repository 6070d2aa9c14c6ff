"""Star-schema loading and roll-ups for plant and operations data on Spark."""
