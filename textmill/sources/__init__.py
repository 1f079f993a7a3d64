"""Readers with explicit schemas."""
