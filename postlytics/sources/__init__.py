"""Readers and writers; formats and addresses are options of the caller."""
