"""Whole jobs composed of operators: the alert poll, the replay, the metadata load, the price landing."""
