"""Governed measures, filters, dimensions, joins and questions over the gold tables."""
