"""Registered queries over the supplied tables, each with its SQL counterpart."""
