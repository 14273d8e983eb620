"""Readers, file manifests, sinks and the bundled test-table adapter."""
