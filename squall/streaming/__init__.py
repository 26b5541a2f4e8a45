"""Structured Streaming jobs: raw archive and windowed KPIs."""
