"""Structured Streaming jobs: arrivals, training trigger, scoring, hourly monitor."""
