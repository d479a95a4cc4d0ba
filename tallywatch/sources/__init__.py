"""Message sources and stored tables."""
