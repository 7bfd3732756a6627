"""Whole runs made of operators: they read and write named tables."""
