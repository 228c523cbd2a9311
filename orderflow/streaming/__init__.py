"""Stream scoring."""
