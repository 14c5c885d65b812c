"""Marts, reports and the layered warehouse."""
