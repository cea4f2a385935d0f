"""Company-360 data product on Spark: bridge, dimension, ledger and marts."""

from entity360.session import tune

__all__ = ["tune"]
