"""Structured Streaming twins of stateful batch operators."""
