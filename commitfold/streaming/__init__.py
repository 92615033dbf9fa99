"""The running collector."""
