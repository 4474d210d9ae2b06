"""Readers and writers of the engine's text, CSV, JSON, libsvm and model files."""
