"""Scans, sinks and the stores for parameters and fitted models."""
