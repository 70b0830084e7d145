"""Batch operators over cells, mutations and text."""
