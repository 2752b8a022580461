"""Registered queries over adapter views, each with the SQL that states it."""
