"""Compositions of operators: mapping presets, serving views, inspection."""
