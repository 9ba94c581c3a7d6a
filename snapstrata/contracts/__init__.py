"""Ready-made dataset contracts."""
