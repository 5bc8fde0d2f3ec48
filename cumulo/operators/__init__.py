"""Composite operators (inventory sections 2B-2P, 2J-2O, 2U)."""
