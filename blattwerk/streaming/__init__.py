from blattwerk.streaming import progress

__all__ = ["progress"]
