"""Scoring a stream of messages into the serving tables."""
