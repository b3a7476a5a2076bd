"""Distributed operators: spatial join, keyed joins with hot keys, hex binning, roll-ups."""
