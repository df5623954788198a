"""The three jobs of a batch and their chain."""
