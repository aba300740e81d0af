from blattwerk.sources.tables import table

__all__ = ["table"]
