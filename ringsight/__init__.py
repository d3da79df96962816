"""Payment-abuse analytics on Spark: transaction scores, account rings, decisions and their audit trail."""

from ringsight.config import Settings

__all__ = ["Settings"]
