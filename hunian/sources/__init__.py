"""Readers and writers of listings, facilities, provinces and pages."""
