"""Operators for language-model training data and entity work; nothing else in orgloom imports this package."""
