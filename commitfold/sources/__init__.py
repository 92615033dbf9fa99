"""Readers and writers: landed frames, progress, tables, and the events adapter."""
