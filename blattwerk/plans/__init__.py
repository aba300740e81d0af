from blattwerk.plans.lineage import broadcast_if_small, cut, spread
from blattwerk.plans.shipping import ship

__all__ = ["broadcast_if_small", "cut", "ship", "spread"]
