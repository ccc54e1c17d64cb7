"""Scalar text functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def email_org(email: Column | str) -> Column:
    """Organisation part of an address: after the last ``@``, up to the first dot.

    Without ``@`` the whole text counts as the domain; NULL stays NULL.
    """
    col = F.col(email) if isinstance(email, str) else email
    return F.substring_index(F.substring_index(col, "@", -1), ".", 1)
