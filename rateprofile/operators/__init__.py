"""DataFrame -> DataFrame operators. Column names are parameters; nothing here
knows about a particular dataset."""

from . import assess, clustering, counts, exposure, families, features, scaling

__all__ = ["assess", "clustering", "counts", "exposure", "families", "features", "scaling"]
