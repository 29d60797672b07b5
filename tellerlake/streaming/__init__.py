"""Structured Streaming jobs: fraud alerts, churn alerts, lake landing and replay."""
