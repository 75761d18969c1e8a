"""Checks of the library on the shared test tables; not part of the library."""
