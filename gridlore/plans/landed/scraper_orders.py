"""Project facts from orders."""

from gridlore.plans.inputs import order_facts as ejecutar_extraccion

__all__ = ["ejecutar_extraccion"]
