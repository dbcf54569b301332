"""Operators of a training-text pipeline. Nothing outside this package imports it."""
