"""Concrete models composed from the operators: staging, warehouse, marts,
reports and quality plans, tied together by ``Layers``."""

from commerce_marts.plans.layers import DRIVER_BAND_CUTS, Layers

__all__ = ["DRIVER_BAND_CUTS", "Layers"]
