"""Queries of the driver contract: every operator applied to the driver's tables."""
