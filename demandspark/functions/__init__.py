from demandspark.functions import features, scalar

__all__ = ["features", "scalar"]
