"""Readers: landing files, raw CSV, manifest, layer tables and the sample inputs."""
