"""Loan-risk analytics on Spark DataFrames.

Every operator takes DataFrames and plain parameters and returns DataFrames; nothing here
holds state between calls.  The column names an operator works on come from a ``RoleMap``.
"""

from loanlens.roles import LOAN_ROLES, RoleMap

__all__ = ["LOAN_ROLES", "RoleMap"]
