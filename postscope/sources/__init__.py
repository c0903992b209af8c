"""Readers: raw post feeds, archives, driver-table adapters."""
