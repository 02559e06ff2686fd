"""Readers and writers: listings, search pages, headers, configs, catalogs, item tables."""
