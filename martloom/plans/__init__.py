"""Composed plans: dimensions, facts and bridges (silver), marts (gold)."""
