"""Micro-batch scoring: sources, scorers, model holder, sinks, serving loop."""
