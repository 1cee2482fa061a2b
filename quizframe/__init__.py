"""Learner-interaction features, ratings and scores as Spark jobs."""
