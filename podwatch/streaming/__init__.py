"""Structured Streaming forms of detection, cooldown and payload landing."""
