"""Readers and writers of the layouts that measurements come in."""
