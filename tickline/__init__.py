"""Part of tickline."""
