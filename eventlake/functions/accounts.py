"""Predicates over account logins."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from eventlake.schema import BOT_SUFFIX


def is_not_bot(login: str | Column) -> Column:
    """True for logins without the bot suffix; NULL (so dropped) for NULL."""
    col = F.col(login) if isinstance(login, str) else login
    return ~col.endswith(BOT_SUFFIX)
