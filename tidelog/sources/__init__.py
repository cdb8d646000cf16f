"""Reading, generating and writing log tables."""
