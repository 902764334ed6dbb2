"""Cue-level text QA, timeline analytics and corpus preparation on PySpark."""
