"""Compositions: conformed tables, star schema, reports, the daily run."""
