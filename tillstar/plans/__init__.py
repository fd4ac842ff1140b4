"""Whole plans: the sales questions, the star build and the printed reports."""
