"""Generation and emission facts from order lines."""

from gridlore.plans.inputs import line_facts as ejecutar_extraccion

__all__ = ["ejecutar_extraccion"]
