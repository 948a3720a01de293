"""Loads every module that registers a query."""

from . import (  # noqa: F401
    decontamination, language, lines, minhash, mixing, packing, repetition, resampling, sharding, spelling, substrings, urls,
    whitening,
)
