"""Spark jobs that turn landed point-of-sale exports into upload-ready tables."""
