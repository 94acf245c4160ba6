"""Whole jobs: views over the star, loads and analyses."""
