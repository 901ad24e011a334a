"""Queries over the engine's operators, each with the SQL it must agree with where SQL can express it."""
