"""Runs the engine on generic order tables: two listing-like sources, one rate series."""
