"""Readers: finished files, message brokers, table schemas, generated messages."""
