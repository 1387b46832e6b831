"""Operators that turn raw text tables into training data. Nothing else in the library imports this package."""
