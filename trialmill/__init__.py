"""Evaluation analytics for A/B runs of agents and skills, expressed as Spark jobs."""
