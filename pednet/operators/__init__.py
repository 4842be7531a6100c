"""Part of the pedestrian-network engine."""
