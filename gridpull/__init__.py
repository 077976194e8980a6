"""gridpull – parameter sheets answered against large tables on Spark."""

from .config import ExtractConfig, Labels

__all__ = ["ExtractConfig", "Labels"]
__version__ = "0.1.0"
