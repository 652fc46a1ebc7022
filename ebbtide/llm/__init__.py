"""Operators that turn raw documents into a training corpus. Nothing else in the library imports them."""
