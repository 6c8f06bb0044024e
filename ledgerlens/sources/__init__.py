"""Readers of landed files: what a fetcher left in a folder becomes rows; nothing here touches a network."""
