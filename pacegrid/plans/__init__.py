"""Runs over all athletes at once: bronze, silver, and both."""
