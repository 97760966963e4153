"""Registered queries: the operators run over the driver's tables, with equivalent SQL."""
