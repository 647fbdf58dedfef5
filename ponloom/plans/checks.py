"""Bounds on query parameters."""

from __future__ import annotations


def bounded(name: str, value: int, low: int, high: int | None = None) -> int:
    if value < low or (high is not None and value > high):
        top = "" if high is None else f" and at most {high}"
        raise ValueError(f"{name} must be at least {low}{top}")
    return value


def one_of(name: str, value: str, allowed: tuple[str, ...]) -> str:
    if value not in allowed:
        raise ValueError(f"{name} must be one of {', '.join(allowed)}")
    return value


def at_least_chars(name: str, value: str, low: int) -> str:
    if len(value) < low:
        raise ValueError(f"{name} needs at least {low} characters")
    return value
