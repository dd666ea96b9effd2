from sellthrough.sinks.warehouse import Warehouse

__all__ = ["Warehouse"]
