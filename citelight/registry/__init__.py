"""Every operator as a query over the star-schema tables, with the SQL it must agree with."""

from .catalog import ORACLE, QUERIES

__all__ = ["ORACLE", "QUERIES"]
