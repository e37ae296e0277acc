"""Composable DataFrame operators. Everything here is lazy: no counts, no collects."""
