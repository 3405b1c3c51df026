"""Continuous counterparts of the batch refreshes."""
