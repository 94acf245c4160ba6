"""Transformations that loads and analyses are composed of."""
