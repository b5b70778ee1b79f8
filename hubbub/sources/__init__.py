"""Readers and writers of articles, tasks, dictionaries, pages and payloads."""
