"""Scans: landed JSON documents, seeds, fixed dimensions, generated spines and tables."""
