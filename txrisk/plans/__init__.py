"""Whole jobs: train, score a stream, report, publish messages."""
