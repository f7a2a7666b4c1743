"""Readers and writers for landed files, metadata documents and run events."""
