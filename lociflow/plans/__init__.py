"""Whole workflows: configuration in, tables out."""
