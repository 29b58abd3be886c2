"""Reusable building blocks shared by both views."""
