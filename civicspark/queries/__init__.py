"""Registered queries: each runs operators over whole tables; SQL stands beside it."""
